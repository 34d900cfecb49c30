"""The operators' contracts, written the plain way for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
A_TO_Z = {c: c + 32 for c in range(65, 91)}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hash_text(text):
    return signed(xxhash.xxh64_intdigest(text.encode(), seed=42))


def hash_two(a, b):
    first = xxhash.xxh64_intdigest(a.to_bytes(8, "little", signed=True), seed=42)
    return signed(xxhash.xxh64_intdigest(b.to_bytes(8, "little", signed=True), seed=first))


def base_counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered.update(range(i, i + 8))
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": failed,
    }


def scores(docs, labels, buckets):
    def grams(text):
        h = [hash_text(w) for w in WORD.findall(text or "")]
        return [x % buckets for x in h + [hash_two(a, b) for a, b in zip(h, h[1:])]]

    verdicts = defaultdict(list)
    for doc_id, quality, toxic in labels:
        if doc_id is not None:
            verdicts[doc_id].append(quality == 1 and toxic == 0)
    trusted = {i for i, v in verdicts.items() if all(v)}
    corpus, good = Counter(), Counter()
    for doc_id, text in docs:
        corpus.update(grams(text))
        if doc_id in trusted:
            good.update(grams(text))
    every, of_good = sum(corpus.values()), sum(good.values())
    ratio = [
        math.log((good[b] + 1) / (of_good + buckets)) - math.log((corpus[b] + 1) / (every + buckets))
        for b in range(buckets)
    ]
    return [sum(ratio[g] for g in grams(text)) / max(1, len(grams(text))) for _, text in docs]


def shingles(text, k):
    words = WORD.findall((text or "").translate(A_TO_Z))
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def near_components(docs, k, percent):
    """doc_id to its component, for unique ids."""
    sets = [(i, shingles(t, k)) for i, t in docs]
    owner = defaultdict(list)
    for n, (_, own) in enumerate(sets):
        for s in own:
            owner[s].append(n)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (_, own) in enumerate(sets):
        common = Counter(m for s in own for m in owner[s] if m < n)
        for m, c in common.items():
            if 100 * c >= percent * (len(own) + len(sets[m][1]) - c):
                a, b = find(n), find(m)
                root[max(a, b, key=lambda x: sets[x][0])] = min(a, b, key=lambda x: sets[x][0])
    return {i: sets[find(n)][0] for n, (i, _) in enumerate(sets)}


def contamination(docs, benchmark):
    windows = defaultdict(set)
    for item, text in benchmark:
        words = ITEM_WORD.findall((text or "").translate(A_TO_Z))
        if words:
            span = min(13, len(words))
            for i in range(len(words) - span + 1):
                windows[tuple(words[i : i + span])].add(item)
    spans = sorted({len(w) for w in windows})
    out = []
    for doc_id, text in docs:
        words = ITEM_WORD.findall((text or "").translate(A_TO_Z))
        hit, items = set(), set()
        for span in spans:
            for i in range(len(words) - span + 1):
                found = windows.get(tuple(words[i : i + span]))
                if found:
                    hit.update(range(i, i + span))
                    items |= {str(x) for x in found if x is not None}
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(items), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return out


def repeats(docs, length=200):
    places = defaultdict(int)
    texts = [(i, (t or "").encode()) for i, t in docs]
    for _, text in texts:
        for i in range(len(text) - length + 1):
            places[hash(text[i : i + length])] += 1
    out = []
    for doc_id, text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if places[hash(text[i : i + length])] > 1:
                gone[i : i + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def sentences(text):
    """Pieces of a text: up to a line break, wide marks, or marks before white space and that space."""
    out, at = [], 0
    while at < len(text):
        end = at
        while end < len(text):
            if text[end] == "\n":
                end += 1
                break
            if text[end] in "。！？":
                while end < len(text) and text[end] in "。！？":
                    end += 1
                end += text[end : end + 1] == "\n"
                break
            if text[end] in ".!?":
                after = end
                while after < len(text) and text[after] in ".!?":
                    after += 1
                if after == len(text) or text[after] in " \t\n。！？":
                    while after < len(text) and text[after] in " \t":
                        after += 1
                    end = after + (text[after : after + 1] == "\n")
                    break
                end = after
            else:
                end += 1
        out.append(text[at:end])
        at = end
    return out


def unit_spans(docs, least):
    """Removed spans by document: runs of repeated sentences, the earliest by id and place kept."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        at, spans, run = 0, [], []
        for unit in [*sentences(text or ""), None]:
            key = tuple(WORD.findall(unit.lower())) if unit else None
            if key and key in seen:
                run.append((at, at + len(unit), max(len(key), len(" ".join(key)) // 6)))
            elif unit is None or key:
                if run and sum(r[2] for r in run) >= least:
                    spans.append(f"{run[0][0]}:{run[-1][1]}")
                run = []
            seen.add(key)
            at += len(unit or "")
        out[doc_id] = ",".join(spans)
    return out


def capacity(sizes, shards):
    """Least capacity of contiguous shards over sizes in order."""
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        used, fill = 1, 0
        for s in sizes:
            if fill + s > mid:
                used, fill = used + 1, 0
            fill += s
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


def _fold(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_fold(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def manifest(rows):
    """Rows (doc_id, source, lang, n_chars, text) as (doc_id, leaf, subroot, root, proof, folded, verified)."""

    def leaf(row):
        return _fold(*map(_framed, row))

    def forged(row):
        if row[0] is None or zlib.crc32(str(row[0]).encode()) % 3 or row[4] is None:
            return row
        return (*row[:4], row[4].translate(A_TO_Z))

    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for own in by_lang.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [_levels([leaf(r) for r in by_lang[x]]) for x in langs]
    top = _levels([t[-1][0] for t in trees]) if trees else []
    out = []
    for number, (lang, tree) in enumerate(zip(langs, trees)):
        for place, row in enumerate(by_lang[lang]):
            proof, folded = [], leaf(forged(row))
            for levels, at in ((tree, place), (top, number)):
                for nodes in levels[:-1]:
                    run = at // 8 * 8
                    left, right = nodes[run:at], nodes[at + 1 : run + 8]
                    proof += left + right
                    folded = _fold(*left, folded, *right)
                    at //= 8
            root = top[-1][0]
            out.append((row[0], tree[0][place], tree[-1][0], root, _fold(*proof), folded, folded == root))
    return out


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranking(docs, items, k):
    """Rows (item_id, rank, doc_id, score)."""
    found = [(i, Counter(TERM.findall((t or "").translate(A_TO_Z)))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    every, length = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(TERM.findall((text or "").translate(A_TO_Z)))
    out = []
    for item, terms in wanted.items():
        scored = []
        for doc_id, counts in found:
            m = 100 - 50 + (50 * sum(counts.values()) * every) // length
            score = 0
            for t in terms & counts.keys():
                w = math.floor(1000 * math.log((2 * every + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, doc_id, -score))
    return out


def vector_links(rows, cosine=0.93):
    """Rows (vec_id, embedding, label) as (vec_id, n_links, component_id, kept)."""
    spaces = defaultdict(list)
    for n, (_, vector, label) in enumerate(rows):
        if vector and label is not None and all(x is not None and math.isfinite(x) for x in vector) and any(vector):
            spaces[label, len(vector)].append(n)
    linked, component = [0] * len(rows), [r[0] for r in rows]
    for own in spaces.values():
        v = np.array([rows[n][1] for n in own], dtype=np.float64)
        v /= np.abs(v).max(axis=1)[:, None]
        v /= np.linalg.norm(v, axis=1)[:, None]
        links = v @ v.T >= cosine
        np.fill_diagonal(links, False)
        label = np.arange(len(own))
        while True:
            least = np.where(links, label[None, :], len(own)).min(axis=1, initial=len(own))
            new = np.minimum(label, least)
            if (new == label).all():
                break
            label = new
        for i, n in enumerate(own):
            linked[n] = int(links[i].sum())
        for root in set(label):
            ids = [rows[own[i]][0] for i in np.flatnonzero(label == root)]
            least = min((x for x in ids if x is not None), default=None)
            for i in np.flatnonzero(label == root):
                component[own[i]] = least
    return [
        (r[0], linked[n], component[n], linked[n] == 0 if r[0] is None else r[0] == component[n])
        for n, r in enumerate(rows)
    ]
