"""Ranked lexical search over an index in strata of equal length normaliser.

A document's score depends on its text through the counts of the item's terms and through its
normaliser ``m`` alone. The index groups documents by ``m``; within a stratum the impact of a posting is a
function of its count, computed once per count. The largest impacts bound what any document of a
stratum can score for an item. Strata are visited in the order of these bounds: the most
promising ones first, and of the others only what can still reach the best scores found there.

Spark partitions and shuffles: postings are stored with their documents, counted by term, stratum and count,
and dealt to tasks in blocks of one stratum; a task adds up the scores of its block.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaymill.llm.common import columns, stored

#: Best documents of an item that are returned.
K = 50
#: Terms that one pass over the texts looks for; all of them are broadcast.
VOCABULARY = 500_000
#: Terms of items, counted for each item, that one search broadcasts.
ITEM_TERMS = 250_000
#: Postings and documents to a block, on average.
BLOCK_POSTINGS = 1 << 17
BLOCK_DOCUMENTS = 1 << 13
#: The first visits are to the most promising strata with this part of the postings.
FIRST = 16
#: Items whose scores a task adds up at once.
ITEMS = 16

# A-Z to a-z, all that is no letter, digit or part of a non-ASCII character to a space.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    """All terms of a text in order."""
    return (text or b"").translate(_TERM_BYTES).split()


def item_terms(items: DataFrame) -> DataFrame:
    """``item``, a number for each item id, and its distinct ``term``s as bytes; null ids are one item."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(text.as_py()))) for text in batch.column("text")]
            rows = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            terms = pa.array([t for x in found for t in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(rows), terms], names=["item_id", "term"])

    texts = columns(items, item_id="item_id", text="text").withColumn("text", F.col("text").cast("binary"))
    kind = texts.schema["item_id"].dataType.simpleString()
    found = stored(texts.mapInArrow(of, f"item_id {kind}, term binary").distinct(), "item-terms")
    return found


@dataclass(frozen=True)
class Index:
    """Documents with their postings in strata.

    ``postings``: one row per document (and pass over the texts) with ``row``, ``doc_id``, ``m``, ``terms``
    and ``tfs``. ``levels``: documents and impact by term, ``m`` and ``tf``. ``vocabulary``:
    numbers of the terms that were indexed.
    """

    postings: DataFrame
    levels: DataFrame
    vocabulary: DataFrame
    documents: int


def _indexing(numbers):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.value.get
        for batch in batches:
            sizes, lengths, found, counts = [], [], [], []
            for text in batch.column("text"):
                words = terms_of(text.as_py())
                here = Counter(map(known, words))
                here.pop(None, None)
                sizes.append(len(words))
                lengths.append(len(here))
                found.extend(here.keys())
                counts.extend(here.values())
            ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(found, pa.int64())),
                    pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32())),
                ],
                names=["row", "doc_id", "n", "terms", "tfs"],
            )

    return of


def build_index(docs: DataFrame, terms: DataFrame) -> Index:
    """Index all documents with a term, with postings for the given distinct ``term``s.

    Terms are broadcast ``VOCABULARY`` at a time, one pass over the texts for each such part.
    """
    spark = docs.sparkSession
    vocabulary = stored(terms.select("term", F.monotonically_increasing_id().alias("number")), "vocabulary")
    passes = max(1, -(-vocabulary.count() // VOCABULARY))
    texts = columns(docs, doc_id="doc_id", text="text").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("binary").alias("text")
    )
    if passes > 1:
        texts = stored(texts, "texts")  # the rows' numbers have to be the same in each pass
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"row bigint, doc_id {kind}, n bigint, terms array<bigint>, tfs array<int>"
    parts = []
    for p in range(passes):
        own = vocabulary.where(F.pmod(F.xxhash64("term"), F.lit(passes)) == p)
        numbers = spark.sparkContext.broadcast({bytes(r["term"]): r["number"] for r in own.toLocalIterator()})
        part = texts.mapInArrow(_indexing(numbers), schema).where("n > 0")
        parts.append(stored(part.withColumn("pass", F.lit(p)), "postings"))
        numbers.unpersist()
    rows = reduce(DataFrame.unionByName, parts)
    documents, words = rows.where("pass = 0").agg(F.count("*"), F.sum("n")).first()
    # Decimal, for the product leaves 64 bits on very large corpora.
    longer = f"(cast({50 * documents} as decimal(38,0)) * n) div {words or 1}"
    postings = rows.withColumn("m", F.expr(f"100 - 50 + {longer}"))
    each = postings.select("m", F.explode(F.arrays_zip("terms", "tfs")).alias("x"))
    levels = each.groupBy(F.col("x.terms").alias("number"), "m", F.col("x.tfs").alias("tf")).agg(
        F.count("*").alias("documents")
    )
    impact = F.expr("(1000000000L * tf) div (1000L * tf + 20 * m)").alias("impact")
    return Index(postings, stored(levels.select("*", impact), "levels"), vocabulary, documents)


def weights(index: Index) -> DataFrame:
    """``number`` and ``w`` of every term that occurs."""
    df = index.levels.groupBy("number").agg(F.sum("documents").alias("df"))
    rarity = F.lit(float(2 * index.documents + 2)) / (2 * F.col("df") + 1).cast("double")
    return df.select("number", F.floor(1000 * F.log(rarity)).alias("w"))


def strata(index: Index) -> DataFrame:
    """Every stratum with its documents, postings and the number of blocks it is dealt in."""
    sizes = index.postings.groupBy("m").agg(
        F.count("*").alias("documents"), F.sum(F.size("terms")).alias("postings")
    )
    blocks = F.greatest(
        F.ceil(F.col("postings") / BLOCK_POSTINGS), F.ceil(F.col("documents") / BLOCK_DOCUMENTS), F.lit(1)
    )
    return stored(sizes.withColumn("blocks", blocks.cast("bigint")), "strata")


def bounds(index: Index, wanted: DataFrame) -> DataFrame:
    """What a document of stratum ``m`` can score at most for each item of ``wanted``."""
    best = index.levels.groupBy("number", "m").agg(F.max("impact").alias("impact"))
    found = wanted.join(best, "number").groupBy("item", "m")
    return stored(found.agg(F.sum(F.col("w") * F.col("impact")).alias("bound")), "bounds")


def most_promising(bound: DataFrame, sizes: DataFrame) -> DataFrame:
    """The strata to visit first: ``m`` by what they can bring, with a part of all postings.

    One row per normaliser is ordered here, as many as there are lengths of texts.
    """
    best = bound.groupBy("item").agg(F.max("bound").alias("best"))
    promise = bound.join(best, "item").groupBy("m").agg(F.sum(F.col("bound") / F.col("best")).alias("promise"))
    order = Window.orderBy(F.desc("promise"), "m")
    before = F.coalesce(F.sum("postings").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("postings").over(Window.partitionBy())
    ranked = promise.join(sizes, "m").select("m", before.alias("before"), total.alias("total"))
    return ranked.where(F.col("before") * FIRST < F.col("total")).select("m")


@dataclass(frozen=True)
class Wanted:
    """Items of a search by term: entry i says that item ``items[i]`` weighs a term with ``w[i]``.

    Entries of the term ``numbers[t]`` are those from ``starts[t]`` to ``starts[t + 1]``.
    ``least`` is the score, by item, from which a document counts.
    """

    numbers: np.ndarray
    starts: np.ndarray
    items: np.ndarray
    w: np.ndarray
    least: np.ndarray

    @staticmethod
    def of(entries: np.ndarray, n_items: int) -> Wanted:
        """From rows (item, number, w)."""
        entries = entries[np.lexsort((entries[:, 0], entries[:, 1]))]
        numbers, starts = np.unique(entries[:, 1], return_index=True)
        return Wanted(
            numbers, np.append(starts, len(entries)), entries[:, 0], entries[:, 2], np.ones(n_items, np.int64)
        )

    def at_least(self, scores: np.ndarray) -> Wanted:
        return Wanted(self.numbers, self.starts, self.items, self.w, scores)


def block_scores(m: int, owner, terms, tfs, n_docs: int, wanted: Wanted, k: int):
    """Yield for each item its best documents in a block: (item, documents, scores).

    Documents stand in the order that decides between equal scores; ``owner`` is a posting's document.
    An item whose bound in the block is too low is not visited.
    """
    place = np.searchsorted(wanted.numbers, terms)
    place[place == len(wanted.numbers)] = 0
    known = wanted.numbers[place] == terms
    owner, place, tfs = owner[known], place[known], tfs[known].astype(np.int64)
    levels, level = np.unique(tfs, return_inverse=True)
    impact = (1_000_000_000 * levels // (1000 * levels + 20 * m))[level]
    best = np.zeros(len(wanted.numbers), np.int64)
    np.maximum.at(best, place, impact)
    of_entry = np.repeat(np.arange(len(wanted.numbers)), np.diff(wanted.starts))
    bound = np.zeros(len(wanted.least), np.int64)
    np.add.at(bound, wanted.items, wanted.w * best[of_entry])
    visited = np.flatnonzero(bound >= wanted.least)
    visited = visited[np.argsort(-bound[visited], kind="stable")]
    for at in range(0, len(visited), ITEMS):
        own = visited[at : at + ITEMS]
        local = np.full(len(wanted.least), -1)
        local[own] = np.arange(len(own))
        entries = np.flatnonzero(local[wanted.items] >= 0)
        first = np.searchsorted(of_entry[entries], np.arange(len(wanted.numbers) + 1))
        each = np.diff(first)[place]
        posting = np.repeat(np.arange(len(place)), each)
        step = np.arange(len(posting)) - np.repeat(np.cumsum(each) - each, each)
        entry = entries[first[place[posting]] + step]
        scores = np.zeros(len(own) * n_docs, np.int64)
        np.add.at(scores, local[wanted.items[entry]] * n_docs + owner[posting], wanted.w[entry] * impact[posting])
        for item, row in zip(own, scores.reshape(len(own), n_docs)):
            docs = np.flatnonzero(row >= wanted.least[item])
            docs = docs[np.argsort(-row[docs], kind="stable")[:k]]
            if len(docs):
                yield item, docs, row[docs]


def _scoring(wanted, k: int, kind: pa.DataType):
    def of(key, block):
        # A document has a row for each pass over the texts; its rows are one document here.
        block = block.sort_by([("doc_id", "ascending"), ("row", "ascending")])  # null ids stand last
        rows = block["row"].to_numpy()
        new = np.append(True, rows[1:] != rows[:-1])
        document = np.cumsum(new) - 1
        terms, tfs = (block[c].combine_chunks() for c in ("terms", "tfs"))
        owner = np.repeat(document, pc.list_value_length(terms).to_numpy(zero_copy_only=False))
        found = list(
            block_scores(
                key[0].as_py(), owner, terms.flatten().to_numpy(), tfs.flatten().to_numpy(),
                int(document[-1]) + 1, wanted.value, k,
            )
        )
        empty = np.zeros(0, np.int64)
        docs = np.concatenate([empty, *(d for _, d, _ in found)])
        return pa.table(
            {
                "item": pa.array(np.repeat([i for i, _, _ in found], [len(d) for _, d, _ in found]), pa.int64()),
                "doc_id": block["doc_id"].take(pa.array(np.flatnonzero(new)[docs])).cast(kind),
                "score": pa.array(np.concatenate([empty, *(s for _, _, s in found)]), pa.int64()),
            }
        )

    return of


def ranked(scores: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(index: Index, wanted: DataFrame, n_items: int, k: int) -> DataFrame:
    """The ``k`` best documents of items 0 to ``n_items`` - 1 from ``wanted`` (item, number, w), which is broadcast."""
    context = wanted.sparkSession.sparkContext
    entries = np.array(wanted.select("item", "number", "w").collect(), dtype=np.int64).reshape(-1, 3)
    by_term = Wanted.of(entries, n_items)
    sizes, bound = strata(index), bounds(index, wanted)
    dealt = index.postings.join(sizes.select("m", "blocks"), "m").withColumn(
        "block", F.pmod(F.xxhash64("row"), F.col("blocks"))
    )
    kind = index.postings.schema["doc_id"].dataType
    schema = f"item bigint, doc_id {kind.simpleString()}, score bigint"

    def visit(rows: DataFrame, items: Wanted) -> DataFrame:
        from pyspark.sql.pandas.types import to_arrow_type

        blocks = rows.select("m", "block", "row", "doc_id", "terms", "tfs").groupBy("m", "block")
        scoring = _scoring(context.broadcast(items), k, to_arrow_type(kind))
        return stored(blocks.applyInArrow(scoring, schema), "scores")

    first = stored(most_promising(bound, sizes), "first-strata")
    early = visit(dealt.join(first, "m", "left_semi"), by_term)
    least = np.ones(n_items, np.int64)
    for r in ranked(early, k).where(F.col("rank") == k).select("item", "score").collect():
        least[r["item"]] = r["score"]
    reached = wanted.sparkSession.createDataFrame(
        list(enumerate(least.tolist())), "item bigint, least bigint"
    )
    rest = bound.join(reached, "item").where("bound >= least").select("m").distinct()
    rest = stored(rest.join(first, "m", "left_anti"), "other-strata")
    late = visit(dealt.join(rest, "m", "left_semi"), by_term.at_least(least))
    return ranked(early.unionByName(late), k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 of every item: item_id, rank, doc_id, score.

    Rows that share an item id are one item with the terms of all of them, null ids being one id too. An item
    without terms, or whose terms occur in no document, has no rows. A null or empty text has no terms and
    is no document. Rows of the documents count each for itself, repeated ones too; of equal scores the
    smaller doc_id comes first, a null one last. Texts of any length are read whole. Other columns are not
    looked at.
    """
    terms = item_terms(items)
    index = build_index(docs, terms.select("term").distinct())
    named = stored(
        terms.select("item_id").distinct().withColumn("key", F.monotonically_increasing_id()), "items"
    )
    searches = max(1, -(-terms.count() // ITEM_TERMS))
    known = (
        terms.join(index.vocabulary, "term")
        .join(weights(index), "number")
        .join(named, terms["item_id"].eqNullSafe(named["item_id"]))
        .select("key", "number", "w")
        .withColumn("search", F.pmod(F.xxhash64("key"), F.lit(searches)))
    )
    known = stored(known, "known-terms")
    spark = docs.sparkSession
    out = []
    for s in range(searches):
        own = known.where(F.col("search") == s)
        keys = sorted(r["key"] for r in own.select("key").distinct().collect())
        if not keys:
            continue
        places = spark.createDataFrame(list(enumerate(keys)), "item bigint, key bigint")
        wanted = stored(own.join(places, "key").select("item", "number", "w"), "wanted")
        out.append(search(index, wanted, len(keys), k).join(places, "item").drop("item"))
    kinds = f"key bigint, rank int, doc_id {index.postings.schema['doc_id'].dataType.simpleString()}, score bigint"
    none = spark.createDataFrame([], kinds)
    found = reduce(DataFrame.unionByName, out, none)
    return found.join(named, "key").select("item_id", "rank", "doc_id", "score")
