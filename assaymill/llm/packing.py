"""Best-fit packing of tokenised documents into sequences, improved by swaps.

Documents become token ids in parallel; what is longer than a sequence is cut into full pieces.
The remaining pieces are dealt evenly, by hash, to groups of bounded size. Inside a group best fit
gives the first packing; a local search then moves pieces, exchanges them one for one or two for
one between underfull sequences. Each step raises the sum of squared fills, so it ends, and
the emptiest sequences run dry.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.llm.common import columns, stored
from assaymill.llm.shingles import spans_hashes

#: Tokens of a sequence, and the id that ends a document.
LENGTH, END = 2048, 0
#: Pieces that one group packs, about.
GROUP = 8192
#: Parts of words whose ids a worker remembers, and their longest.
REMEMBERED, LONGEST = 1_000_000, 48
#: Texts that are encoded together.
AT_ONCE = 256

# The tokenizer's split of lower-case text, for the characters up to U+00FF: runs of letters, single
# digits, runs of others, and an apostrophe that begins a part with the ending after it.
_LETTERS, _DIGITS, _SPACES = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", r" \t-\r\x85\xa0"
_ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")
_KIND = np.full(256, 3, dtype=np.uint8)
for _number, _class in ((0, _SPACES), (1, _LETTERS), (2, _DIGITS)):
    _KIND[[ord(c) for c in map(chr, range(256)) if re.match(f"[{_class}]", c)]] = _number
#: In other text, what stands between ASCII white space; the tokenizer never looks across it.
_WORD = re.compile(r"[^ \t-\r]+")


def split_parts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the parts of lower-case Latin-1 text begin, and their lengths."""
    kind = _KIND[data]
    starts = kind != 0
    starts[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    marks = np.flatnonzero(starts & (data == 0x27))
    after = np.append(data, np.zeros(3, np.uint8))
    for ending in _ENDINGS:
        own = marks
        for place, letter in enumerate(ending.encode(), 1):
            own = own[after[own + place] == letter]
        starts[own + 1] = False
        following = own + 1 + len(ending)
        following = following[following < len(data)]
        starts[following[kind[following] != 0]] = True
    starts = np.flatnonzero(starts)
    written = np.append(0, np.cumsum(kind != 0))
    return starts, np.diff(written[np.append(starts, len(data))])


class WordTokenizer:
    """Ids of texts, as little-endian unsigned 32-bit, for a tokenizer that drops white space.

    Such a tokenizer treats every word by itself, so parts of words are encoded once and
    remembered by a 64-bit hash. Text beyond U+00FF is taken word by word, and a text that holds a
    special token as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[int | str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in encoded]

    def __call__(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        plain: list[int] = []
        raw: list[bytes] = []
        if len(self.known) > REMEMBERED:
            self.known.clear()
        for number, text in enumerate(texts):
            if "<|" in text and any(s in text.lower() for s in self.special):
                out[number] = self._encode([text])[0]
                continue
            try:
                raw.append(text.lower().encode("latin-1"))
                plain.append(number)
            except UnicodeEncodeError:
                out[number] = self._by_words(text)
        for number, ids in zip(plain, self._by_parts(raw)):
            out[number] = ids
        return out

    def _by_words(self, text: str) -> bytes:
        words = _WORD.findall(text)
        new = list({w for w in words if w not in self.known})
        fresh = dict(zip(new, self._encode(new)))
        self.known.update((w, ids) for w, ids in fresh.items() if len(w) <= LONGEST)
        return b"".join([fresh[w] if w in fresh else self.known[w] for w in words])

    def _by_parts(self, texts: list[bytes]) -> list[bytes]:
        joined = b" ".join(texts)
        data = np.frombuffer(joined, np.uint8)
        starts, lengths = split_parts(data)
        if not len(starts):
            return [b""] * len(texts)
        hashes = spans_hashes(data, starts, lengths)
        hashes, first, part = np.unique(hashes, return_index=True, return_inverse=True)
        keys = hashes.tolist()
        ids = list(map(self.known.get, keys))
        new = [i for i, own in enumerate(ids) if own is None]
        spans = [(int(starts[f]), int(lengths[f])) for f in first[new]]
        fresh = self._encode([joined[at : at + n].decode("latin-1") for at, n in spans])
        for i, (_, n), own in zip(new, spans, fresh):
            ids[i] = own
            if n <= LONGEST:
                self.known[keys[i]] = own
        sizes = np.array([len(own) // 4 for own in ids])
        pool = np.frombuffer(b"".join(ids), dtype="<u4")
        begins = np.cumsum(sizes) - sizes
        counts = sizes[part]
        ends = np.cumsum(counts)
        tokens = pool[np.repeat(begins[part] - (ends - counts), counts) + np.arange(ends[-1])]
        borders = np.cumsum([len(t) + 1 for t in texts])
        upto = np.append(0, ends)[np.searchsorted(starts, borders)]
        return [tokens[a:b].tobytes() for a, b in zip(np.append(0, upto[:-1]), upto)]


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One for all tasks of a worker process."""
    return WordTokenizer(path)


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length`` and ``ids_crc32`` of every piece of every document."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_tokenizer(tokenizer)
        end = np.array([END], dtype="<u4").tobytes()
        for batch in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            for low in range(0, batch.num_rows, AT_ONCE):
                texts = [t or "" for t in batch.column(1)[low : low + AT_ONCE].to_pylist()]
                for number, ids in enumerate(encode(texts), low):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids), 4 * length)):
                        part = ids[start : start + 4 * length]
                        rows.append((number, piece, start // 4, len(part) // 4, zlib.crc32(part)))
            owner, *numbers = (np.array(c, dtype=np.int64) for c in zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner)),
                    pa.array(numbers[0].astype(np.int32)),
                    *(pa.array(n) for n in numbers[1:]),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select("doc_id", "text").mapInArrow(of, schema)


def best_fit(sizes: np.ndarray, room: int) -> list[list[int]]:
    """Bins of item numbers: largest item first, into the fullest bin that has room."""
    order = np.argsort(-sizes, kind="stable")
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(room + 1)]
    frees: list[int] = []  # the distinct free spaces that some bin has, sorted
    for item in order.tolist():
        size = int(sizes[item])
        at = bisect_left(frees, size)
        if at < len(frees):
            free = frees[at]
            own = by_free[free].pop()
            if not by_free[free]:
                frees.pop(at)
            bins[own].append(item)
            free -= size
        else:
            own, free = len(bins), room - size
            bins.append([item])
        if free:
            if not by_free[free]:
                insort(frees, free)
            by_free[free].append(own)
    return bins


class _Bin:
    """Items of one sequence, and the sizes of what it could give back: nothing, one item or two."""

    def __init__(self, items: list[int], sizes: np.ndarray, room: int):
        self.items = items
        own = sizes[items] if items else np.empty(0, np.int64)
        self.fill = int(own.sum())
        self.free = room - self.fill
        self.first, self.second = np.triu_indices(len(items), 1)
        self.parts = np.concatenate(([0], own, own[self.first] + own[self.second]))

    def back(self, part: int) -> list[int]:
        n = len(self.items)
        if part == 0:
            return []
        if part <= n:
            return [self.items[part - 1]]
        return [self.items[self.first[part - n - 1]], self.items[self.second[part - n - 1]]]


def improve(bins: list[list[int]], sizes: np.ndarray, room: int) -> list[list[int]]:
    """Empty the emptiest bins by moves and exchanges that raise the sum of squared fills.

    The emptiest bin gives: an item moves to another underfull bin, or goes there in exchange for
    one smaller item, or for two that are smaller together, so that the other bin gets as full
    as can be. As the other bin is the fuller one, every step raises the sum of squares.
    The search ends when the emptiest bin can give nothing, or when the bins are as few as the
    total size allows.
    """
    full = [b for b in bins if int(sizes[b].sum()) == room]
    rest = sorted((_Bin(b, sizes, room) for b in bins if int(sizes[b].sum()) < room), key=lambda b: b.fill)
    while len(rest) > -(-sum(b.fill for b in rest) // room):
        giver, others = rest[0], rest[1:]
        if not _give(giver, others, sizes, room):
            break
        others += [_Bin(giver.items, sizes, room)] if giver.items else []
        full += [b.items for b in others if not b.free]
        rest = sorted((b for b in others if b.free), key=lambda b: b.fill)
    return full + [b.items for b in rest]


def _give(giver: _Bin, others: list[_Bin], sizes: np.ndarray, room: int) -> bool:
    """One pass over the giver's items, largest first, each other bin taking part at most once."""
    sizes_back = np.concatenate([b.parts for b in others])
    starts = np.concatenate(([0], np.cumsum([len(b.parts) for b in others])))
    free = np.repeat([b.free for b in others], np.diff(starts))
    moved = False
    for item in sorted(giver.items, key=lambda i: -int(sizes[i])):
        gain = int(sizes[item]) - sizes_back
        fits = (gain > 0) & (gain <= free)
        if not fits.any():
            continue
        # An item that can go for nothing does; else the other bin gets as full as it can.
        moves = fits & (sizes_back == 0)
        left = np.where(moves if moves.any() else fits, free - gain, room + 1)
        part = int(np.argmin(left))
        own = int(np.searchsorted(starts, part, side="right")) - 1
        other = others[own]
        back = other.back(part - int(starts[own]))
        giver.items = [i for i in giver.items if i != item] + back
        others[own] = _Bin([i for i in other.items if i not in back] + [item], sizes, room)
        free[starts[own] : starts[own + 1]] = -1
        moved = True
    return moved


def _packed(room: int):
    def of(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=False, kind="stable")
        sizes = group["length"].to_numpy()
        bins = improve(best_fit(sizes, room), sizes, room)
        order = np.concatenate([np.array(b) for b in bins])
        number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        out = group.iloc[order].reset_index(drop=True)
        out["sequence_id"] = 2 * (out["part"].astype("int64") * (1 << 32) + number)
        out["offset"] = out["length"].cumsum() - out["length"]
        out["offset"] -= out.groupby("sequence_id")["offset"].transform("min")
        return out.drop(columns="part")

    return of


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """One row per piece with its sequence and place in it.

    A null or empty text is the end token alone. Repeated rows and rows without an id are packed
    each. An empty table gives no rows. Other columns are not looked at. Sequence ids
    are even for packed and odd for full pieces; the number of groups follows the number of documents.
    """
    docs = columns(docs, doc_id="doc_id", text="text")
    rows = stored(pieces(docs, tokenizer, length), "pieces")
    full = F.col("length") == length
    alone = F.monotonically_increasing_id() * 2 + 1
    whole = rows.where(full).select("*", alone.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = rows.where(~full)
    groups = part.count() // GROUP + 1
    schema = whole.schema
    spread = F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups))
    packed = (
        part.withColumn("part", spread)
        .groupBy("part")
        .applyInPandas(_packed(length), schema)
    )
    return whole.unionByName(packed)
