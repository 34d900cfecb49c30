"""Benchmark decontamination by winnowing.

Of the hashes of all 8-word grams inside a window of 13 words the least one is kept. A window
that a document shares with a benchmark item yields the same least hash on both sides, so the
join of the kept hashes misses no shared span of 13 words or more. Each hit is extended to its
whole window and compared word by word. Items of fewer words are one window of their own
length, with their own pass over the grams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.llm.common import ascii_lower, columns, stored

#: Words of a window and of a gram.
SPAN, GRAM = 13, 8
#: Fingerprints that are broadcast at once, 8 bytes each: more are taken in blocks.
BLOCK = 1_000_000
#: What stands between words, for Java and RE2, after A-Z have become a-z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def _folded(column: str, apart: int, function: str) -> str:
    """``function`` of an array's values ``apart`` places apart."""
    n = f"greatest(size({column}) - {apart}, 0)"
    return f"zip_with(slice({column}, 1, {n}), slice({column}, {1 + apart}, {n}), (a, b) -> {function})"


def _spread(df: DataFrame, column: str, size: int, function: str) -> DataFrame:
    """``column`` becomes the function over ``size`` neighbours, doubling and then overlapping."""
    wide = 1
    while wide < size:
        step = min(wide, size - wide)
        df = df.withColumn(column, F.expr(_folded(column, step, function)))
        wide += step
    return df


def windows(df: DataFrame, span: int, prints: DataFrame | None = None) -> DataFrame:
    """A row per window of ``span`` words: its place ``s``, kept hash ``fp`` and ``window``.

    ``df`` has the array ``words``; its other columns stay. With ``prints``, one column ``print``, only
    windows with such a hash are returned, and words are put together for these alone.
    """
    gram = min(GRAM, span)
    others = [c for c in df.columns if c != "words"]
    out = df.withColumn("prints", F.transform("words", lambda word: F.xxhash64(word)))
    out = _spread(out, "prints", gram, "xxhash64(a, b)")
    out = _spread(out, "prints", span - gram + 1, "least(a, b)")
    # The outer form, as the plain one adds a filter that repeats all steps above; a text without
    # windows gives one null, which goes.
    out = out.select(*others, "words", F.posexplode_outer("prints").alias("s", "fp")).where("fp IS NOT NULL")
    if prints is not None:
        out = out.join(F.broadcast(prints), F.col("fp") == prints["print"], "left_semi")
    window = F.array_join(F.slice("words", F.col("s") + 1, span), " ")
    return out.select(*others, "s", "fp", window.alias("window"))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct windows with their length, kept hash and the sorted items that have them.

    Rows without an id have windows too, and are in no list of items.
    """
    items = columns(benchmark, item="item_id", text="text")
    items = items.select(F.col("item").cast("string").alias("item"), item_words(F.col("text")).alias("words"))
    items = stored(items.where(F.size("words") > 0), "benchmark-words")
    short = F.size("words") < SPAN
    spans = [r[0] for r in items.where(short).select(F.size("words")).distinct().collect()]
    parts = [
        windows(items.where(F.size("words") == n) if n < SPAN else items, n)
        .select(F.lit(n).alias("span"), "fp", "window", "item")
        for n in sorted({*spans, SPAN})
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return stored(
        every.groupBy("span", "fp", "window")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .withColumn("items_key", F.sha2(F.concat_ws(",", "items"), 256)),
        "benchmark-windows",
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """``row`` with all columns, and a key that tells rows with one id and two texts apart."""
    return docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
    )


def _same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["id"].eqNullSafe(right["hit_id"]) & (left["text_hash"] == right["hit_hash"])


def document_hits(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Windows of documents that are windows of an item: id, text hash, place, span, items key."""
    sizes = found.groupBy("span").agg(F.count_distinct("fp").alias("n")).collect()
    texts = _keyed(docs).select("id", "text_hash", item_words(F.col("row.text")).alias("words"))
    parts = []
    for span, n in sorted(tuple(r) for r in sizes):
        blocks = -(-n // BLOCK)
        for block in range(blocks):
            prints = (
                found.where((F.col("span") == span) & (F.pmod("fp", F.lit(blocks)) == block))
                .select(F.col("fp").alias("print"))
                .distinct()
            )
            places = windows(texts, span, prints)
            parts.append(places.select("id", "text_hash", "s", F.lit(span).alias("span"), "window"))
    if not parts:
        return None
    candidates = parts[0]
    for part in parts[1:]:
        candidates = candidates.unionByName(part)
    candidates = stored(candidates, "candidate-windows")
    return candidates.join(found.select("span", "window", "items_key"), ["span", "window"]).select(
        "id", "text_hash", "s", "span", "items_key"
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame | None:
    """Hit documents: ``hit_id``, ``hit_hash``, ``n_hit``, ``n_items``, ``items_sha256``.

    Documents with the same sets of items share one list of items. None if no item has words.
    """
    found = benchmark_windows(benchmark)
    hits = document_hits(docs, found)
    if hits is None:
        return None
    by_doc = hits.groupBy("id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("s", (F.col("s") + F.col("span")).alias("e")))).alias("places"),
        F.array_sort(F.collect_set("items_key")).alias("keys"),
    )
    covered = F.expr("""
        aggregate(places, named_struct('n', 0L, 'last', 0),
            (a, p) -> named_struct('n', a.n + greatest(p.e - greatest(p.s, a.last), 0),
                                   'last', greatest(p.e, a.last)),
            a -> a.n)""")
    by_doc = stored(
        by_doc.select(
            F.col("id").alias("hit_id"),
            F.col("text_hash").alias("hit_hash"),
            covered.alias("n_hit"),
            F.col("keys"),
            F.sha2(F.concat_ws(",", "keys"), 256).alias("keys_key"),
        ),
        "hit-documents",
    )
    lists = found.select("items_key", "items").dropDuplicates(["items_key"])
    merged = (
        by_doc.select("keys_key", "keys")
        .dropDuplicates(["keys_key"])
        .select("keys_key", F.explode("keys").alias("items_key"))
        .join(lists, "items_key")
        .groupBy("keys_key")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        .select(
            "keys_key",
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        )
    )
    return by_doc.drop("keys").join(merged, "keys_key").drop("keys_key")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, hit words, items and the verdict.

    A document is contaminated when at least one word in twenty is inside a benchmark window.
    Null and empty texts have no words. Rows without an id are answered too; repeated rows each;
    benchmark rows that share an id are one item. Passages of rows without an id make hit words like any
    other, but are no item. Benchmark rows without words are left out.
    Empty tables give no rows or no hits. Other columns are not looked at.
    """
    hits = contamination(docs, benchmark)
    every = _keyed(columns(docs, doc_id="doc_id", text="text")).select(
        "id", "text_hash", F.size(item_words(F.col("row.text"))).cast("long").alias("n_words")
    )
    none = F.sha2(F.lit(""), 256)
    if hits is None:
        out = every.select("id", "n_words", F.lit(0).cast("long").alias("n_hit"),
                           F.lit(0).cast("long").alias("n_items"), none.alias("items_sha256"))
    else:
        out = every.join(hits, _same_row(every, hits), "left").select(
            "id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items_sha256", none).alias("items_sha256"),
        )
    verdict = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return out.withColumnRenamed("id", "doc_id").withColumn("contaminated", verdict)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns.

    Rows with a null or empty text or without an id, repeated rows and further columns stay as they
    are; an empty benchmark keeps every row, and an empty table gives no rows.
    """
    hits = contamination(docs, benchmark)
    if hits is None:
        return docs
    rows = _keyed(docs)
    n_words = F.size(item_words(F.col("row.text")))
    return (
        rows.join(hits.select("hit_id", "hit_hash", "n_hit"), _same_row(rows, hits), "left")
        .where(F.col("n_hit").isNull() | (20 * F.col("n_hit") < n_words))
        .select("row.*")
    )
