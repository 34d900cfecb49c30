"""SQL of another engine for the queries that SQL can express, over the whole tables."""

from __future__ import annotations

from assaymill.llm.common import LOWER, UPPER

_WORD = r"[^\x20\x09-\x0D]+"
_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{pattern}')"


NEAR_DUPLICATES = f"""
    WITH RECURSIVE texts AS (SELECT doc_id, {_words("text", _WORD)} AS w FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s
        FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i
              FROM texts WHERE len(w) > 0)
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    pairs AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
    ),
    links AS (
        SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * c >= 85 * (x.n + y.n - c)
    ),
    ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach(doc_id, other) AS (
        SELECT doc_id, doc_id FROM documents
        UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON ways.a = reach.other
    ),
    least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
    FROM documents JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

DECONTAMINATION = f"""
    WITH items AS (
        SELECT item_id, {_words("text", _ITEM_WORD)} AS w FROM benchmark
    ),
    item_windows AS (
        SELECT DISTINCT item_id, span, array_to_string(w[i : i + span - 1], ' ') AS x
        FROM (SELECT *, least(13, len(w)) AS span,
                  unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i
              FROM items WHERE len(w) > 0)
    ),
    texts AS (SELECT doc_id, {_words("text", _ITEM_WORD)} AS w FROM documents),
    places AS (
        SELECT doc_id, span, i, array_to_string(w[i : i + span - 1], ' ') AS x
        FROM (SELECT doc_id, w, span, unnest(generate_series(1, len(w) - span + 1)) AS i
              FROM texts, (SELECT DISTINCT span FROM item_windows) WHERE len(w) >= span)
    ),
    hits AS (SELECT doc_id, span, i, item_id FROM places JOIN item_windows USING (span, x)),
    covered AS (
        SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(i, i + span - 1)) AS p FROM hits) GROUP BY doc_id
    ),
    found AS (
        SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS list
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL)
        GROUP BY doc_id
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(list, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM texts LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_SENTENCE = (
    r"(?:[^\n.!?。！？]+|[.!?]+[^\n.!?。！？\x20\t])*(?:[。！？]+|[.!?]*[\x20\t]*)\n?"
)

LINES = f"""
    WITH pieces AS (
        SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS place
        FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SENTENCE}') AS p FROM documents)
    ),
    worded AS (
        SELECT *, array_to_string(regexp_extract_all(lower(piece), '{_WORD}'), ' ') AS key,
            sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY place)::BIGINT AS ends
        FROM pieces WHERE piece <> ''
    ),
    units AS (
        SELECT *, greatest(len(string_split(key, ' ')), length(key) // 6) AS size,
            row_number() OVER (PARTITION BY key ORDER BY doc_id, place) > 1 AS gone,
            row_number() OVER (PARTITION BY doc_id ORDER BY place) AS number
        FROM worded WHERE key <> ''
    ),
    runs AS (
        SELECT doc_id, min(place) AS first, max(place) AS last, count(*) AS units,
            min(ends - length(piece)) AS starts, max(ends) AS ends
        FROM (
            SELECT *, number - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run FROM units WHERE gone
        )
        GROUP BY doc_id, run HAVING sum(size) >= 25
    ),
    kept AS (
        SELECT doc_id, string_agg(piece, '' ORDER BY place) AS text
        FROM worded w ANTI JOIN runs r ON w.doc_id = r.doc_id AND w.place BETWEEN r.first AND r.last
        GROUP BY doc_id
    ),
    removed AS (
        SELECT doc_id, sum(units)::BIGINT AS n_removed, sum(ends - starts)::BIGINT AS n_removed_chars,
            string_agg(starts || ':' || ends, ',' ORDER BY starts) AS removed_spans
        FROM runs GROUP BY doc_id
    ),
    counted AS (SELECT doc_id, count(*)::BIGINT AS n_units FROM units GROUP BY doc_id)
    SELECT doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed,
        coalesce(n_removed_chars, 0) AS n_removed_chars, coalesce(removed_spans, '') AS removed_spans,
        CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
    FROM documents d LEFT JOIN counted USING (doc_id) LEFT JOIN removed USING (doc_id)
    LEFT JOIN kept k USING (doc_id)
"""


def _framed(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NULL THEN '-'"
        f" ELSE strlen({column}::VARCHAR) || ':' || {column}::VARCHAR END"
    )


_HEAD = " || ".join(f"({_framed(c)})" for c in ("doc_id", "source", "lang", "n_chars"))

# The checksum of the id, bit by bit: this engine has no function for it.
_CRC32 = """xor(list_reduce(
            list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ord(ch)::BIGINT)),
            lambda state, byte: list_reduce(
                list_concat([xor(state, byte)], range(8)),
                lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)
            )
        ), 4294967295)"""

MANIFEST = f"""
    WITH RECURSIVE hashed AS (
        SELECT doc_id, lang, sha256({_HEAD} || ({_framed("text")})) AS leaf,
            CASE WHEN {_CRC32} % 3 = 0 THEN sha256({_HEAD} || ({_framed(f"translate(text, '{UPPER}', '{LOWER}')")})) END AS other
        FROM documents
    ),
    bottom AS (
        SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, leaf,
            coalesce(other, leaf) AS forged,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
            count(*) OVER (PARTITION BY lang) AS n
        FROM hashed
    ),
    up AS (
        SELECT tree, 0 AS level, pos, leaf AS h, n FROM bottom
        UNION ALL
        SELECT tree, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8
        FROM up WHERE n > 1 GROUP BY tree, level, pos // 8, n
    ),
    subroots AS (SELECT tree, level, h FROM up WHERE n = 1),
    top AS (
        SELECT 0 AS level, tree AS pos, h, count(*) OVER () AS n FROM subroots
        UNION ALL
        SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8
        FROM top WHERE n > 1 GROUP BY level, pos // 8, n
    ),
    root AS (SELECT h AS root FROM top WHERE n = 1),
    nodes AS (
        SELECT tree, level, pos, h FROM up WHERE n > 1
        UNION ALL SELECT -1, level, pos, h FROM top WHERE n > 1
    ),
    beside AS (
        SELECT tree, level, pos,
            coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
            coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
        FROM nodes WINDOW run AS (PARTITION BY tree, level, pos // 8 ORDER BY pos)
    ),
    climb AS (
        SELECT tree AS own, pos AS place, 0 AS steps, CASE WHEN n = 1 THEN -1 ELSE tree END AS tree, 0 AS level,
            CASE WHEN n = 1 THEN tree ELSE pos END AS pos, '' AS proof, forged AS folded
        FROM bottom
        UNION ALL
        SELECT own, place, steps + 1,
            CASE WHEN s.tree IS NULL THEN b.tree ELSE -1 END,
            CASE WHEN s.tree IS NULL THEN b.level + 1 ELSE 0 END,
            CASE WHEN s.tree IS NULL THEN b.pos // 8 ELSE s.tree END,
            proof || l || r, sha256(l || folded || r)
        FROM climb c JOIN beside b ON c.tree = b.tree AND c.level = b.level AND c.pos = b.pos
        LEFT JOIN subroots s ON s.tree = b.tree AND s.level = b.level + 1
    ),
    longest AS (
        SELECT own, place, arg_max(proof, steps) AS proof, arg_max(folded, steps) AS folded
        FROM climb GROUP BY own, place
    )
    SELECT doc_id, leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root,
        folded = root AS verified
    FROM bottom b JOIN longest ON own = b.tree AND place = b.pos JOIN subroots s ON s.tree = b.tree, root
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

RANKING = f"""
    WITH texts AS (
        SELECT row_number() OVER () AS doc, doc_id, {_words("text", _TERM)} AS w FROM documents
    ),
    totals AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS words FROM texts WHERE len(w) > 0),
    tf AS (
        SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(w) AS term FROM texts) GROUP BY doc, term
    ),
    items AS (SELECT DISTINCT item_id, unnest({_words("text", _TERM)}) AS term FROM benchmark),
    weights AS (
        SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
        FROM tf, totals GROUP BY term, docs
    ),
    lengths AS (
        SELECT doc, doc_id, 100 - 50 + (50 * len(w) * docs) // words AS m FROM texts, totals WHERE len(w) > 0
    ),
    scores AS (
        SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
        FROM items JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (doc)
        GROUP BY item_id, doc, doc_id
    ),
    ranked AS (
        SELECT *, row_number() OVER (
            PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
        FROM scores WHERE score > 0
    )
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

SQL = {
    "op11_lexical": RANKING,
    "op4_minhash": NEAR_DUPLICATES,
    "op5_winnowing": DECONTAMINATION,
    "op6_lines": LINES,
    "op13_merkle": MANIFEST,
}
