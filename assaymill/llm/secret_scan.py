"""Secrets in texts: fixed patterns, and random strings found by a battery of randomness tests.

Long strings of code characters are candidates; their encoding (hex, base32 or base64)
is read from their characters. Three statistics are taken: the chi-squared uniformity of the
symbols over the encoding's alphabet, the number of runs of character classes and the serial
correlation of neighbouring symbols. A candidate is called random if

* none of the three rejects "uniformly random" (``ACCEPT`` standard deviations), and
* the three together reject "ordinary string", whose means and spreads per encoding and length
  come from the corpus' candidates. These p-values pass a false-discovery control (Benjamini and
  Hochberg) inside each length class, so that many short strings do not drown few long ones.

All steps are narrow but three: places of matches are summed up within a document, the corpus'
statistics and the histogram of p-values are aggregates of fixed size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaymill.llm.common import columns, stored

#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "random")

# The base patterns and the least length of the assigned value. For the two kinds that
# match a whole run of characters, the least length is part of the pattern. An assignment too short
# still uses up its text, so its length is looked at after the match.
PATTERNS = {
    "assign": (
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
        r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    ),
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"[0-9a-f]{16,}",
    # Candidates of the battery: whole runs of code characters that are long enough to test.
    "random": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}",
}
ASSIGNED = 12

ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}

#: Standard deviations at which one of the tests rejects "random".
ACCEPT = 3.5
#: Share of false ones among the strings called random.
FALSE_SHARE = 0.01
#: Length classes end before these lengths.
CLASSES = (32, 64, 128)
#: Steps of the histogram of -log10 p, and its end.
STEPS, DEEPEST = 10, 300


def _cell(kind: int):
    """A match with the piece before it, as both come from one pattern."""
    return lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.char_length(x["0"]).alias("gap"), x["1"].alias("value")
    )


def matches(rows: DataFrame) -> DataFrame:
    """``id``, ``text_hash``, ``kind``, ``start``, ``stop`` and ``value`` of every match.

    ``rows`` has ``id``, ``text_hash`` and ``text``. A pattern splits the text into pieces and
    matches in turn, so a running sum of their lengths gives the places. (The outer form of
    inline, as the plain one adds a filter that runs all patterns again.)
    """
    text = F.col("text")
    parts = []
    for number, kind in enumerate(KINDS):
        pieces = F.split(text, PATTERNS[kind])
        found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
        cells = F.transform(F.arrays_zip(pieces, found), _cell(number))
        parts.append(F.when(text.rlike(PATTERNS[kind]), cells))
    cells = F.array_compact(F.flatten(F.array_compact(F.array(*parts))))
    every = rows.select("id", "text_hash", F.inline_outer(cells)).where("value IS NOT NULL")
    upto = Window.partitionBy("id", "text_hash", "kind").orderBy("i")
    length = F.char_length("value")
    value = F.col("value")
    long_enough = F.when(
        F.col("kind") == 0,
        F.char_length(F.regexp_extract(value, PATTERNS["assign"], 2)) >= ASSIGNED,
    ).otherwise(F.lit(True))
    return (
        every.dropDuplicates(["id", "text_hash", "kind", "i"])
        .withColumn("stop", F.sum(F.col("gap") + length).over(upto))
        .where(long_enough)
        .select("id", "text_hash", "kind", (F.col("stop") - length).alias("start"), "stop", "value")
    )


def _normal_tail(z: Column) -> Column:
    """-log10 of the probability that a normal variable exceeds z, about; 0.3 for z below 0."""
    up = F.greatest(z, F.lit(0.0))
    return (0.30103 + (0.717 * up + 0.416 * up * up) / 2.302585).alias("depth")


def _measured(candidates: DataFrame) -> DataFrame:
    """Candidates with length ``n``, ``encoding`` and the three raw statistics.

    ``pairs``: share of equal pairs of symbols, which is the chi-squared statistic up to its
    expected value; ``turns``: share of neighbours of unlike class; ``serial``: correlation
    of neighbours.
    """
    kept = candidates.columns
    bare = F.col("bare")
    symbols = F.lit(ALPHABETS["base64"])
    for name in ("base32", "hex"):
        symbols = F.when(F.col("encoding") == name, F.lit(ALPHABETS[name])).otherwise(symbols)
    classes = bare
    for letters, mark in (("[a-z]", "a"), ("[A-Z]", "B"), ("[0-9]", "1")):
        classes = F.regexp_replace(classes, letters, mark)
    out = candidates.withColumn(
        "bare", F.translate(F.regexp_replace("value", "=+$", ""), "-_", "+/")
    ).select(
        *kept,
        F.when(bare.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(bare.rlike("^[A-Z2-7]+$"), "base32")
        .otherwise("base64")
        .alias("encoding"),
        F.char_length(bare).alias("n"),
        F.split(classes, "").alias("classes"),
        "bare",
    )
    plain = F.when(F.col("encoding") == "hex", F.lower(bare)).otherwise(bare)
    out = out.withColumn("chars", F.split(plain, "")).withColumn("symbols", symbols)
    out = out.select(
        *kept,
        "encoding",
        "n",
        "classes",
        F.array_sort("chars").alias("ordered"),
        F.transform("chars", lambda c: F.instr(F.col("symbols"), c).cast("double")).alias("x"),
    ).withColumn("mean", F.expr("aggregate(x, 0D, (t, v) -> t + v) / n"))
    neighbours = "zip_with(slice({0}, 1, n - 1), slice({0}, 2, n - 1), (a, b) -> {1})"
    turned = neighbours.format("classes", "CASE WHEN a = b THEN 0D ELSE 1D END")
    together = neighbours.format("x", "(a - mean) * (b - mean)")
    return out.select(
        *kept,
        "encoding",
        "n",
        # After sorting, each symbol pairs with the equal ones just before it.
        F.expr("""
            aggregate(ordered, named_struct('last', '', 'run', 0L, 'pairs', 0L),
                (a, c) -> CASE WHEN c = a.last
                    THEN named_struct('last', c, 'run', a.run + 1, 'pairs', a.pairs + a.run)
                    ELSE named_struct('last', c, 'run', 1L, 'pairs', a.pairs) END,
                a -> a.pairs) / (n * (n - 1D) / 2)""").alias("pairs"),
        F.expr(f"aggregate({turned}, 0D, (t, x) -> t + x) / (n - 1)").alias("turns"),
        F.expr(f"""
            coalesce(try_divide(
                aggregate({together}, 0D, (t, v) -> t + v),
                aggregate(x, 0D, (t, v) -> t + (v - mean) * (v - mean))), 1D)""").alias("serial"),
    )


def _expected() -> tuple[Column, Column]:
    """Symbols of the encoding, and the chance that neighbours of a random string differ in class."""
    size = F.when(F.col("encoding") == "hex", 16.0).when(F.col("encoding") == "base32", 32.0).otherwise(64.0)
    turn = (
        F.when(F.col("encoding") == "hex", 1 - (10 * 10 + 6 * 6) / 256)
        .when(F.col("encoding") == "base32", 1 - (26 * 26 + 6 * 6) / 1024)
        .otherwise(1 - (26 * 26 * 2 + 10 * 10 + 2 * 2) / 4096)
    )
    return size, turn


def random_strings(candidates: DataFrame) -> DataFrame:
    """The candidates that the battery calls random, of all candidates together."""
    measured = stored(_measured(candidates), "measured")
    n = F.col("n").cast("double")
    size, turn = _expected()
    band = F.lit(0)
    for number, end in enumerate(CLASSES, 1):
        band = F.when(F.col("n") >= end, number).otherwise(band)
    pairs_all = n * (n - 1) / 2
    z_uniform = (F.col("pairs") - 1 / size) / F.sqrt((1 / size) * (1 - 1 / size) / pairs_all)
    z_turns = (F.col("turns") - turn) / F.sqrt(turn * (1 - turn) / (n - 1))
    z_serial = F.col("serial") * F.sqrt(n)
    accepted = (z_uniform <= ACCEPT) & (F.abs(z_turns) <= ACCEPT) & (F.abs(z_serial) <= ACCEPT)
    tested = measured.select("*", band.alias("band"), accepted.alias("accepted"), size.alias("symbols"))
    # Ordinary strings: what the tests reject as random. Without any, a plain prior stands in.
    usual = (
        tested.where("NOT accepted")
        .groupBy()
        .agg(
            F.coalesce(F.avg("pairs"), F.lit(0.07)).alias("usual_pairs"),
            F.coalesce(F.avg("turns"), F.lit(0.05)).alias("usual_turns"),
            F.coalesce(F.avg("serial"), F.lit(0.0)).alias("usual_serial"),
        )
        .select(F.struct("usual_pairs", "usual_turns", "usual_serial"))
        .scalar()
    )
    tested = tested.withColumn("usual", usual)
    p0 = F.greatest(F.col("usual.usual_pairs"), F.lit(1e-3))
    t0 = F.least(F.greatest(F.col("usual.usual_turns"), F.lit(0.01)), F.lit(0.5))
    # The spread of the share of equal pairs has a term that falls with n only.
    spread = F.sqrt(p0 * (1 - p0) / pairs_all + 4 * p0 * p0 / n)
    z_pairs = (p0 - F.col("pairs")) / spread
    # Classes come in clusters, so their spread counts twice; the serial test counts as far as
    # ordinary strings are correlated at all.
    z_classes = (F.col("turns") - t0) / F.sqrt(t0 * (1 - t0) / (n - 1)) / 2
    r0 = F.col("usual.usual_serial")
    z_neighbours = F.signum(r0) * (r0 - F.col("serial")) * F.sqrt(n)
    z = (z_pairs + z_classes + F.abs(r0) * z_neighbours) / F.sqrt(2 + r0 * r0)
    depth = F.least(F.floor(_normal_tail(z) * STEPS), F.lit(DEEPEST * STEPS)).cast("int")
    scored = stored(tested.select(*measured.columns, "band", "accepted", depth.alias("depth")), "scored")
    return scored.join(F.broadcast(discovery_depths(scored)), "band").where("accepted AND depth >= needed")


def discovery_depths(scored: DataFrame) -> DataFrame:
    """For each length class the least -log10 p, in steps, that the control lets pass.

    p times the number of tests must stay under ``FALSE_SHARE`` times the number of
    strings with such a p or a smaller one. The histogram has a fixed number of rows.
    """
    histogram = scored.groupBy("band", "depth").agg(F.count("*").alias("k"))
    deeper = Window.partitionBy("band").orderBy(F.desc("depth"))
    tests = F.sum("k").over(Window.partitionBy("band"))
    allowed = F.log10(F.lit(FALSE_SHARE) * F.sum("k").over(deeper) / tests)
    return (
        histogram.select("band", "depth", allowed.alias("allowed"))
        .where(-F.col("depth") / STEPS <= F.col("allowed"))
        .groupBy("band")
        .agg(F.min("depth").alias("needed"))
    )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
    )


def _all_spans(docs: DataFrame) -> DataFrame:
    """A row per span: ``id``, ``text_hash``, ``kind``, ``start``, ``stop``."""
    rows = _keyed(docs).select("id", "text_hash", F.coalesce("row.text", F.lit("")).alias("text"))
    found = stored(matches(rows), "matches")
    candidate = F.col("kind") == KINDS.index("random")
    keep = ["id", "text_hash", "kind", "start", "stop"]
    return found.where(~candidate).select(*keep).unionByName(
        random_strings(found.where(candidate)).select(*keep)
    )


def _by_document(spans: DataFrame) -> DataFrame:
    """``hit_id``, ``hit_hash`` and ``spans`` in order of start, then kind."""
    parts = [c for c in ("start", "kind", "stop") if c in spans.columns]
    return spans.groupBy(F.col("id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).agg(
        F.array_sort(F.collect_list(F.struct(*parts))).alias("spans")
    )


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: base spans by kind, their digest, and all spans.

    Places are code points, ends exclusive; a span is the whole match. Null and empty texts have no
    spans. Rows without an id are answered too, repeated rows each; an empty table gives no rows.
    Other columns are not looked at.
    """
    docs = columns(docs, doc_id="doc_id", text="text")
    hits = _by_document(_all_spans(docs))
    rows = _keyed(docs).select("id", "text_hash")
    same = rows["id"].eqNullSafe(hits["hit_id"]) & (rows["text_hash"] == hits["hit_hash"])
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,stop:bigint>>"))
    out = rows.join(hits, same, "left").select("id", spans.alias("spans"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < KINDS.index("random"))
    return out.select(
        F.col("id").alias("doc_id"),
        *(count(k).alias(f"n_{KINDS[k]}") for k in range(4)),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def _apart(spans: DataFrame) -> DataFrame:
    """Spans with those that overlap made one."""
    doc = Window.partitionBy("id", "text_hash").orderBy("start", "stop")
    before = F.max("stop").over(doc.rowsBetween(Window.unboundedPreceding, -1))
    first = F.coalesce(F.col("start") >= before, F.lit(True)).cast("int")
    return (
        spans.withColumn("first", first)
        .withColumn("part", F.sum("first").over(doc.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("id", "text_hash", "part")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    )


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` with every span of a secret replaced, overlapping ones by one mark.

    All rows stay, with all their columns: null and empty texts as they are, rows without an id and repeated
    rows like any other. An empty table gives no rows.
    """
    hits = _by_document(_apart(_all_spans(docs)))
    rows = _keyed(docs)
    same = rows["id"].eqNullSafe(hits["hit_id"]) & (rows["text_hash"] == hits["hit_hash"])
    joined = rows.join(hits, same, "left").withColumn(
        "chars", F.when(F.col("spans").isNotNull(), F.split(F.col("row.text"), ""))
    )
    between = F.expr("""
        zip_with(
            concat(array(0L), transform(spans, s -> s.stop)),
            concat(transform(spans, s -> s.start), array(CAST(size(chars) AS bigint))),
            (a, b) -> array_join(slice(chars, CAST(a AS int) + 1, CAST(b - a AS int)), ''))""")
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(F.array_join(between, mark))
    return joined.select(
        *(text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns)
    )
