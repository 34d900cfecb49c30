"""Suffix-array dedup: every byte inside a long string that also starts elsewhere is removed.

Windows of ``LENGTH`` bytes with the same content share their least 16-byte gram, at the same offset.
So they also share the half window on that side of the gram where more of the window lies: the gram
with the 92 bytes after it, or with those before it. The windows of a text are cut into segments of one
such core, the anchor, and a window can only repeat among segments of its anchor:

1. Segments are counted by anchor and content. Equal contents repeat as a whole.
2. Anchors with several contents, some of them single, need a closer look. Their contents, each once,
   are dealt to groups. A group builds the run-length compressed Burrows-Wheeler transform of
   its contents with the suffixes at the ends of its runs sampled; only there the longest match with a
   neighbouring suffix is measured. Streaming over the text, the match of the next position is
   the last one less one or the next sample, whichever reaches further: these matching statistics mark
   all windows that repeat.
3. Marks go back to all copies of a segment, and each document drops the union of its spans.

An anchor with more contents than a group should hold has its windows counted by digest instead,
which combines on the map side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.llm.common import columns, stored
from assaymill.llm.near_duplicates import text_chunks
from assaymill.llm.shingles import mix

#: Bytes of a string that must not repeat, and of an anchor gram.
LENGTH, GRAM = 200, 16
#: Contents that a group indexes, about, and at most per anchor.
GROUP, MOST = 4096, 16384

U = np.uint64
_PLACE_BITS = 22


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes from every position that has so many."""
    x = data.astype(U)
    for width in (1, 2, 4):
        x = x[: len(x) - width] | (x[width:] << U(8 * width))
    return mix(x[:-8] * U(0x9E3779B97F4A7C15) + mix(x[8:]))


def segments(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and anchor hash of each segment of one text.

    Of equal least hashes the leftmost counts, so the anchor depends on the window's bytes only.
    Long texts are worked on in stretches that overlap by a window.
    """
    stretch = (1 << _PLACE_BITS) - 1
    windows = len(data) - length + 1
    half = (length - GRAM) // 2
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for low in range(0, max(windows, 0), stretch - length):
        high = min(low + stretch - length, windows)
        hashes = gram_hashes(data[low : high + length - 1])
        places = np.arange(len(hashes), dtype=U)
        least = (hashes & ~U((1 << _PLACE_BITS) - 1)) | places
        wide, want = 1, length - GRAM + 1
        while wide < want:
            step = min(wide, want - wide)
            least = np.minimum(least[: len(least) - step], least[step:])
            wide += step
        at = (least & U((1 << _PLACE_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        at, end = at[first], np.append(first[1:], high - low)
        # Windows from the middle on have more after the gram, those before it more before.
        middle = np.clip(at - half, first, end)
        for begin, stop, shift in ((first, middle, -half), (middle, end, 0)):
            some = begin < stop
            core = at[some] + shift
            anchor = np.full(len(core), shift + half, dtype=U)
            for place in (*range(0, half, GRAM), half):
                anchor = mix(anchor * U(0x9E3779B97F4A7C15) + hashes[core + place])
            parts.append((begin[some] + low, (stop - begin)[some], anchor))
    if not parts:
        none = np.empty(0, np.int64)
        return none, none, none.astype(U)
    first, count, anchor = (np.concatenate(p) for p in zip(*parts))
    order = np.argsort(first, kind="stable")
    return first[order], count[order], anchor[order]


def _segment_rows(length: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_chunks(batch.column("text")):
                raw = data.tobytes()
                owner, firsts, counts, anchors, digests = [], [], [], [], []
                for number in range(high - low):
                    a, b = int(offsets[number]), int(offsets[number + 1])
                    first, count, anchor = segments(data[a:b], length)
                    own = [
                        hashlib.blake2b(raw[a + f : a + f + c + length - 1], digest_size=8).digest()
                        for f, c in zip(first.tolist(), count.tolist())
                    ]
                    owner.append(np.full(len(first), low + number))
                    firsts.append(first)
                    counts.append(count)
                    anchors.append(anchor)
                    digests.append(np.frombuffer(b"".join(own), np.int64))
                rows = pa.array(np.concatenate(owner))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(rows),
                        batch.column("text_hash").take(rows),
                        pa.array(np.concatenate(firsts).astype(np.int32)),
                        pa.array(np.concatenate(counts).astype(np.int32)),
                        pa.array(np.concatenate(anchors).view(np.int64)),
                        pa.array(np.concatenate(digests)),
                    ],
                    names=["id", "text_hash", "first", "windows", "anchor", "digest"],
                )

    return of


class RunLengthIndex:
    """Run-length compressed Burrows-Wheeler transform of several contents.

    Suffixes are sorted by doubling; each content ends with a separator of its own, which
    matches nothing. ``heads`` and ``tails`` are the places in suffix order where runs begin and
    end, ``samples`` the text positions there.
    """

    def __init__(self, contents: list[bytes]):
        sizes = np.array([len(c) + 1 for c in contents])
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        ends = self.starts[1:] - 1
        text = np.frombuffer(b"\0".join(contents) + b"\0", np.uint8).astype(np.int64) + 1
        text[ends] = 0
        # The first ranks come from 7 symbols at once; what follows a separator does not count, and
        # suffixes that reach one are told apart by it, in the order of the contents.
        key, within = text.copy(), text > 0
        for place in range(1, 7):
            key *= 512
            within[len(text) - place :] = False
            key[: len(text) - place][within[: len(text) - place]] += text[place:][
                within[: len(text) - place]
            ]
            within[: len(text) - place] &= text[place:] > 0
        order = np.argsort(key, kind="stable")
        apart = np.append(False, (np.diff(key[order]) != 0) | ~within[order[1:]])
        rank, width = np.empty(len(text), dtype=np.int64), 7
        rank[order] = np.cumsum(apart)
        text[text > 0] += len(contents)
        text[ends] = np.arange(len(contents))
        self.text, self.ends = text, np.repeat(ends, sizes)
        while rank[order[-1]] < len(text) - 1:
            following = np.zeros(len(text), dtype=np.int64)
            following[: len(text) - width] = rank[width:] + 1
            key = rank * (int(rank.max()) + 2) + following
            order = np.argsort(key)
            grown = np.empty(len(text), dtype=np.int64)
            grown[order] = np.cumsum(np.append(0, np.diff(key[order]) != 0))
            rank, width = grown, width * 2
        self.order = order
        last = text[order - 1]  # the byte before each suffix, in suffix order
        new = np.append(True, last[1:] != last[:-1])
        self.heads = np.flatnonzero(new)
        self.tails = np.append(self.heads[1:], len(text)) - 1
        self.samples = np.stack((order[self.heads], order[self.tails]))

    def _common(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffix pairs."""
        room = np.minimum(self.ends[left] - left, self.ends[right] - right)
        size = np.zeros(len(left), dtype=np.int64)
        open_pairs = np.flatnonzero(room > 0)
        while len(open_pairs):
            block = 16
            at = size[open_pairs, None] + np.arange(block)
            within = at < room[open_pairs, None]
            at = np.minimum(at, np.maximum(room[open_pairs, None] - 1, 0))
            same = (
                self.text[left[open_pairs, None] + at] == self.text[right[open_pairs, None] + at]
            ) & within
            run = np.where(same.all(axis=1), block, same.argmin(axis=1))
            size[open_pairs] += run
            open_pairs = open_pairs[(run == block) & (size[open_pairs] < room[open_pairs])]
        return size

    def matching_statistics(self) -> np.ndarray:
        """For each text position, the longest match with a suffix elsewhere.

        With the suffix before it in order, the match of a position that is no head of a run is that of
        the position before it, less one; with the suffix after it, that of a position that is no
        tail. So only samples are compared, and a running maximum of reach carries them on.
        """
        position = np.arange(len(self.text))
        out = np.zeros(len(self.text), dtype=np.int64)
        for places, positions, step in (
            (self.heads, self.samples[0], -1),
            (self.tails, self.samples[1], 1),
        ):
            inside = (places + step >= 0) & (places + step < len(self.text))
            here, there = positions[inside], self.order[places[inside] + step]
            reach = np.zeros(len(self.text), dtype=np.int64)
            reach[here] = here + self._common(here, there)
            out = np.maximum(out, np.maximum.accumulate(reach) - position)
        return np.minimum(out, self.ends - position)


def _ranges(flags: np.ndarray) -> list[int]:
    """First and last place, in turn, of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    edges[1::2] -= 1
    return edges.tolist()


def _marked(length: int):
    def of(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        contents = group["content"].tolist()
        index = RunLengthIndex(contents)
        repeated = index.matching_statistics() >= length
        for number, (digest, copies) in enumerate(zip(group["digest"], group["copies"])):
            if copies == 1:
                a = int(index.starts[number])
                found = _ranges(repeated[a : a + len(contents[number]) - length + 1])
                if found:
                    out.append((group["anchor"].iloc[number], digest, found))
        return pd.DataFrame(out, columns=["anchor", "digest", "ranges"])

    return of


def _window_rows(length: int):
    """Digests of all windows of a content, for anchors of very many contents."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                content, n = row["content"], len(row["content"]) - length + 1
                own = [hashlib.blake2b(content[i : i + length], digest_size=16).digest() for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["anchor"]] * n, pa.int64()),
                        pa.array([row["digest"]] * n, pa.int64()),
                        pa.array([row["copies"]] * n, pa.int64()),
                        pa.array(range(n), pa.int32()),
                        pa.array(own, pa.binary()),
                    ],
                    names=["anchor", "digest", "copies", "place", "window"],
                )

    return of


def _by_window(contents: DataFrame, length: int) -> DataFrame:
    """``anchor``, ``digest`` and ``ranges`` of single contents, from counts of window digests."""
    schema = "anchor bigint, digest bigint, copies bigint, place int, window binary"
    rows = stored(contents.select("anchor", "digest", "copies", "content").mapInArrow(_window_rows(length), schema), "windows")
    often = rows.groupBy("window").agg(F.sum("copies").alias("times")).where("times > 1").select("window")
    return (
        rows.where("copies = 1")
        .join(often, "window")
        .groupBy("anchor", "digest")
        .agg(F.array_sort(F.collect_list("place")).alias("places"))
        .select("anchor", "digest", F.expr("flatten(transform(places, p -> array(p, p)))").alias("ranges"))
    )


def _contents(length: int):
    """Bytes of the wanted segments of a text."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                text = (batch.column("text")[row].as_py() or "").encode()
                wanted = batch.column("wanted")[row].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([w["anchor"] for w in wanted], pa.int64()),
                        pa.array([w["digest"] for w in wanted], pa.int64()),
                        pa.array([w["copies"] for w in wanted], pa.int64()),
                        pa.array(
                            [text[w["first"] : w["first"] + w["windows"] + length - 1] for w in wanted],
                            pa.binary(),
                        ),
                    ],
                    names=["anchor", "digest", "copies", "content"],
                )

    return of


def _cut(length: int):
    """What is left of a text, and the removed spans, from its repeated windows."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column("text"), batch.column("found")
            out: list[tuple] = []
            for row in range(batch.num_rows):
                text = (texts[row].as_py() or "").encode()
                ranges = found[row].as_py() or []
                spans: list[list[int]] = []
                for low, high in sorted((r["low"], r["high"] + length) for r in ranges):
                    if spans and low <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], high)
                    else:
                        spans.append([low, high])
                kept, at = [], 0
                for low, high in spans:
                    kept.append(text[at:low])
                    at = high
                kept.append(text[at:])
                left = b"".join(kept)
                flat = [x for span in spans for x in span]
                out.append((len(text), len(text) - len(left), len(spans), hashlib.sha256(left).hexdigest(), flat))
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            kinds = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array([o[i] for o in out], k) for i, k in enumerate(kinds))],
                names=["doc_id", *names],
            )

    return of


def repeated_segments(texts: DataFrame, length: int) -> DataFrame:
    """``id``, ``text_hash`` and ``found``, the first and last starts of repeated windows."""
    kind = texts.schema["id"].dataType.simpleString()
    schema = f"id {kind}, text_hash bigint, first int, windows int, anchor bigint, digest bigint"
    rows = stored(texts.mapInArrow(_segment_rows(length), schema), "segments")
    often = rows.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    often = stored(often, "often")
    rows = stored(
        rows.join(often, "anchor").withColumn("at", F.xxhash64("id", "text_hash", "first")),
        "repeated-anchors",
    )
    contents = stored(
        rows.groupBy("anchor", "digest").agg(F.count("*").alias("copies"), F.min("at").alias("at")), "contents"
    )
    open_anchors = stored(
        contents.groupBy("anchor")
        .agg(F.count("*").alias("contents"), F.min("copies").alias("fewest"))
        .where("contents > 1 AND fewest = 1")
        .select("anchor", (F.col("contents") > MOST).alias("many")),
        "open-anchors",
    )
    wanted = (
        contents.join(open_anchors, "anchor")
        .join(rows.select("anchor", "digest", "at", "id", "text_hash", "first", "windows"), ["anchor", "digest", "at"])
        .dropDuplicates(["anchor", "digest"])
    )
    wanted = stored(
        wanted.select(
            "id", "text_hash", F.struct("anchor", "digest", "copies", "first", "windows").alias("w"), "many"
        ),
        "wanted",
    )
    by_text = wanted.groupBy(F.col("id").alias("wanted_id"), F.col("text_hash").alias("wanted_hash")).agg(
        F.collect_list("w").alias("wanted")
    )
    same = texts["id"].eqNullSafe(by_text["wanted_id"]) & (texts["text_hash"] == by_text["wanted_hash"])
    fetched = (
        texts.join(by_text, same)
        .select("text", "wanted")
        .mapInArrow(_contents(length), "anchor bigint, digest bigint, copies bigint, content binary")
    )
    fetched = stored(fetched.join(open_anchors, "anchor"), "open-contents")
    groups = fetched.where("NOT many").count() // GROUP + 1
    marks = (
        fetched.where("NOT many")
        .withColumn("group", F.pmod(F.xxhash64("anchor"), F.lit(groups)))
        .groupBy("group")
        .applyInPandas(_marked(length), "anchor bigint, digest bigint, ranges array<int>")
    )
    if not fetched.where("many").isEmpty():
        marks = marks.unionByName(_by_window(fetched.where("many"), length))
    whole = contents.where("copies > 1").select(
        "anchor", "digest", F.lit(None).cast("array<int>").alias("ranges")
    )
    marks = stored(whole.unionByName(marks), "marks")
    pairs = F.expr("""
        CASE WHEN ranges IS NULL THEN array(struct(first AS low, first + windows - 1 AS high))
        ELSE transform(sequence(0, size(ranges) - 1, 2),
                       i -> struct(first + ranges[i] AS low, first + ranges[i + 1] AS high)) END""")
    return (
        rows.join(marks, ["anchor", "digest"])
        .select(F.col("id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), pairs.alias("pairs"))
        .groupBy("hit_id", "hit_hash")
        .agg(F.flatten(F.collect_list("pairs")).alias("found"))
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: its bytes, those removed, their spans and the digest of the rest.

    A null text is empty. Texts are judged as given, so all copies of a string go, and matches never
    cross documents. Rows that repeat an id and text count as one document's rows: if the text
    repeats in another row, its bytes repeat. An empty table gives no rows. Other columns are not
    looked at.
    """
    texts = columns(docs, id="doc_id", text="text").withColumn(
        "text_hash", F.xxhash64(F.coalesce("text", F.lit("")))
    )
    found = repeated_segments(texts, length)
    same = texts["id"].eqNullSafe(found["hit_id"]) & (texts["text_hash"] == found["hit_hash"])
    kind = texts.schema["id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<bigint>"
    )
    return texts.join(found, same, "left").select("id", "text", "found").mapInArrow(_cut(length), schema)
