"""Main text of web pages: a linear-chain conditional random field over the leaf blocks.

A page is cut into blocks, the stretches of text between block-level tags. A block's features
are the tags and the class and id words of its ancestors, and measures of its text. A two-label chain
model is trained on labelled pages by its conditional likelihood; the best labelling of a
page is found by Viterbi. The labelled pages are drawn by a seeded generator of layouts, so
training is the same every time and needs no table.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from assaymill.llm.common import columns

#: Labelled pages that the model is trained on, and rounds over them.
TRAINING_PAGES, ROUNDS = 1200, 10

# Fixed values of the markup language.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "svg", "iframe", "textarea", "select")
#: Of these, those that a browser reads to the end of the page if nothing closes them.
TO_THE_END = ("script", "style", "textarea")
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt"
    " ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "option": ("option", ("select",)),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*')*)>"
    r"|<(/?)([a-zA-Z][^\s/><]*)[^><]*>",
    re.S,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[a-z]+")


def _closed(html: str, tag: str) -> dict[int, int]:
    """Starts of the elements ``tag`` that an end tag closes, with the start of that end tag."""
    out: dict[int, int] = {}
    opened: list[int] = []
    for found in re.finditer(rf"<(/?){tag}(?![^\s/>])[^<>]*>?", html, re.I):
        if not found[1]:
            if tag != "svg" or not found[0].endswith("/>"):
                opened.append(found.start())
        elif opened:
            out[opened.pop()] = found.start()
    return out


class _Open:
    """An open element: its tag and the features of it and its ancestors."""

    __slots__ = ("tag", "features", "link")

    def __init__(self, tag: str, features: tuple[str, ...], link: bool):
        self.tag, self.features, self.link = tag, features, link


def blocks(html: str) -> list[tuple[str, tuple[str, ...], int]]:
    """Text, ancestor features and characters in links of every leaf block, in page order."""
    root = _Open("", (), False)
    stack = [root]
    out: list[tuple[str, tuple[str, ...], int]] = []
    parts: list[str] = []
    features: tuple[str, ...] = ()
    linked = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = "".join(parts)
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                out.append((text, features, linked))
            parts, linked = [], 0

    def close(tags: str, borders: tuple[str, ...]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in tags.split():
                del stack[depth:]
                return
            if stack[depth].tag in borders:
                return

    def add(text: str) -> None:
        nonlocal features, linked
        if text and (parts or not text.isspace()):
            if not parts:
                features = next((e for e in reversed(stack) if e.tag not in INLINE), root).features
            parts.append(text)
            if stack[-1].link:
                linked += len(text.strip())

    at, size = 0, len(html)
    closed: dict[str, dict[int, int]] = {}
    while at < size:
        token = _TOKEN.search(html, at)
        if not token:
            add(html[at:])
            break
        add(html[at : token.start()])
        at = token.end()
        tag = (token[2] or token[5] or "").lower()
        if not tag:
            continue
        if token[1] or token[4]:
            if tag not in INLINE:
                flush()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                if tag in INLINE and stack[depth].tag not in INLINE:
                    break
            continue
        if tag in INLINE:
            if tag == "br":
                add(" ") if parts else None
        else:
            flush()
            if tag in CLOSES:
                close(*CLOSES[tag])
            else:
                close("p", ("td", "th", "li", "table", "div", "article", "section", "button"))
        if tag in TO_THE_END:
            end = re.compile(rf"</{tag}\b", re.I).search(html, at)
            at = end.start() if end else size
            continue
        if tag in RAW:
            # Self-closed, or never closed: only the tag is left out, and what follows is read on.
            if tag != "svg" or not token[0].endswith("/>"):
                if tag not in closed:
                    closed[tag] = _closed(html, tag)
                at = closed[tag].get(token.start(), at)
            continue
        if tag in VOID:
            continue
        parent = stack[-1]
        own = [f"tag={tag}"] if tag not in INLINE else []
        if tag not in INLINE and token[3]:
            for found in _NAMES.finditer(token[3]):
                words = _PARTS.findall((found[1] or found[2] or found[3] or "").lower())
                own += [f"name={w}" for w in words]
        new = tuple(dict.fromkeys(f for f in own if f not in parent.features))
        stack.append(_Open(tag, parent.features + new, parent.link or tag == "a"))
    flush()
    return out


def text_features(text: str, linked: int, parent: str) -> tuple[str, ...]:
    """What a block looks like, apart from its place."""
    n = len(text)
    stops = text.count(". ") + text.count("? ") + text.count("! ") + (text[-1] in ".?!…\"'")
    size = min(n.bit_length(), 11)
    out = [f"size={size}", f"stops={min(stops, 4)}", f"links={min(4 * linked // max(n, 1), 4)}"]
    out.append(f"{parent} size={size // 2}")
    if "©" in text[:40]:
        out.append("sign")
    if text[-1] in ".?!":
        out.append("ends")
    return tuple(out)


def block_features(page: list[tuple[str, tuple[str, ...], int]]) -> list[tuple[tuple[str, ...], tuple[str, ...]]]:
    out = []
    for text, above, linked in page:
        parent = next((f for f in reversed(above) if f.startswith("tag=")), "tag=")
        out.append((above, text_features(text, linked, parent)))
    return out


class Chain:
    """Two labels, 0 for the rest and 1 for main text: weights of features, of neighbours and of the first."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.next = [[0.0, 0.0], [0.0, 0.0]]
        self.first = [0.0, 0.0]

    def train(self, pages: list[tuple[list[tuple[str, ...]], list[int]]], rounds: int, rate: float = 0.3) -> None:
        """Adagrad on the conditional log-likelihood, page by page, in a fixed order."""
        squares: dict = {}

        def step(table, key, gradient: float, name) -> None:
            squares[name] = squares.get(name, 1e-2) + gradient * gradient
            table[key] = (table.get(key, 0.0) if isinstance(table, dict) else table[key]) * (
                1 - 1e-4
            ) + rate * gradient / math.sqrt(squares[name])

        for _ in range(rounds):
            for features, labels in pages:
                scores = [sum(self.weights.get(f, 0.0) for f in own) for own in features]
                chance, pairs = self.marginals(scores)
                for own, label, p in zip(features, labels, chance):
                    for f in own:
                        step(self.weights, f, label - p, f)
                for label in (0, 1):
                    p = chance[0] if label else 1 - chance[0]
                    step(self.first, label, (labels[0] == label) - p, ("first", label))
                    for after in (0, 1):
                        seen = sum(a == label and b == after for a, b in zip(labels, labels[1:]))
                        step(self.next[label], after, seen - pairs[label][after], ("next", label, after))

    def marginals(self, scores: list[float]) -> tuple[list[float], list[list[float]]]:
        """Chance of label 1 at each block, and expected counts of neighbouring labels."""
        n = len(scores)
        turn = np.exp(np.array(self.next))
        own = np.exp(np.array([[0.0, max(-30.0, min(30.0, s))] for s in scores]))
        ahead, back = np.zeros((n, 2)), np.ones((n, 2))
        ahead[0] = np.exp(np.array(self.first)) * own[0]
        ahead[0] /= ahead[0].sum()
        for i in range(1, n):
            ahead[i] = (ahead[i - 1] @ turn) * own[i]
            ahead[i] /= ahead[i].sum()
        for i in range(n - 2, -1, -1):
            back[i] = turn @ (own[i + 1] * back[i + 1])
            back[i] /= back[i].sum()
        chance = ahead * back
        chance /= chance.sum(axis=1, keepdims=True)
        pairs = np.zeros((2, 2))
        for i in range(1, n):
            joint = ahead[i - 1][:, None] * turn * (own[i] * back[i])[None, :]
            pairs += joint / joint.sum()
        return chance[:, 1].tolist(), pairs.tolist()

    def best(self, scores: list[float]) -> list[int]:
        """The most likely labels, by Viterbi."""
        (n00, n01), (n10, n11) = self.next
        zero, one = self.first[0], self.first[1] + scores[0]
        came = []
        for s in scores[1:]:
            from_zero, from_one = zero + n00 >= one + n10, zero + n01 >= one + n11
            came.append((0 if from_zero else 1, 0 if from_one else 1))
            zero, one = (
                zero + n00 if from_zero else one + n10,
                (zero + n01 if from_one else one + n11) + s,
            )
        labels = [1 if one > zero else 0]
        for pair in reversed(came):
            labels.append(pair[labels[-1]])
        return labels[::-1]


# --- labelled pages -----------------------------------------------------------------------------


def _sentence(draw: random.Random, low: int, high: int) -> str:
    syllables = "an be co di er fa go hu in ka lo mi ne or pa qui ré sa tü vo".split()
    words = ["".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(draw.randint(low, high))]
    return " ".join(words).capitalize()


def _prose(draw: random.Random) -> str:
    n = draw.choice((1, 1, 2, 3, 5, 8))
    text = " ".join(_sentence(draw, 1, 18) + draw.choice(".....?!") for _ in range(n))
    if draw.random() < 0.1:  # signs, shouting and tables written as text are no one's mark
        text = draw.choice((text.upper(), text.replace(" ", " | "), text.replace(" ", "%% "), "&copy; " + text))
    return text


def labelled_page(draw: random.Random) -> tuple[str, list[int]]:
    """A page of a random layout, and for each of its blocks whether it is main text."""
    out: list[str] = []
    labels: list[int] = []

    def put(tag: str, text: str, label: int, names: str = "") -> None:
        out.append(f"<{tag}{names}>{text}</{tag}>")
        labels.append(label)

    def named(*words: str) -> str:
        word = draw.choice(words)
        return draw.choice((f' class="{word}"', f' id="{word}"', f' class="box {word}"'))

    def links(label: int = 0) -> None:
        out.append("<ul>")
        for _ in range(draw.randint(2, 7)):
            put("li", f'<a href="/x">{_sentence(draw, 1, 3)}</a>', label)
        out.append("</ul>")

    def side(kind: str) -> None:
        if kind == "menu":
            shape = draw.choice(("<nav>", "<nav>", f"<div{named('menu', 'nav', 'navbar', 'breadcrumb')}>"))
            out.append(shape)
            links()
            out.append("</nav>" if shape == "<nav>" else "</div>")
        elif kind == "advert":
            names = named("ad", "ads", "advert", "advertisement", "adbox", "banner", "promo", "sponsored", "sponsor")
            tag = draw.choice(("div", "div", "aside", "section"))
            if draw.random() < 0.4:
                out.append(f"<{tag}{names}>")
                for _ in range(draw.randint(1, 2)):
                    put(draw.choice(("p", "p", "h4", "div")), _prose(draw), 0)
                out.append(f"</{tag}>")
            else:
                put(tag, _prose(draw), 0, names)
        elif kind == "notice":
            names = named(
                "cookie", "cookies", "notice", "notification", "consent", "alert", "popup", "newsletter", "modal",
                "subscribe", "signup", "message", "warning", "privacy",
            )
            if draw.random() < 0.2:
                names = draw.choice((' role="alert"', ' role="dialog"', ' role="banner"'))
            tag = draw.choice(("div", "div", "section", "aside", "p"))
            if tag != "p" and draw.random() < 0.5:
                out.append(f"<{tag}{names}>")
                put("p", _prose(draw), 0)
                put("button", _sentence(draw, 1, 2), 0) if draw.random() < 0.5 else None
                out.append(f"</{tag}>")
            else:
                put(tag, _prose(draw), 0, names)
        elif kind == "aside":
            tag, names = draw.choice((("aside", ""), ("div", named("sidebar", "side", "related", "widget", "share", "social", "recommended", "tags"))))
            out.append(f"<{tag}{names}>")
            if draw.random() < 0.5:
                put("h3", _sentence(draw, 1, 4), 0)
            for _ in range(draw.randint(0, 2)):
                put("p", _prose(draw), 0)
            links()
            out.append(f"</{tag}>")
        elif kind == "form":
            out.append("<form>")
            put(draw.choice(("p", "label", "div")), _sentence(draw, 1, 6), 0) if draw.random() < 0.5 else put(
                "div", _sentence(draw, 1, 6), 0
            )
            put("button", _sentence(draw, 1, 2), 0)
            out.append("</form>")
        elif kind == "comments":
            tag = draw.choice(("section", "div", "ol"))
            out.append(f"<{tag}{named('comments', 'comment', 'discussion', 'replies', 'responses', 'respond', 'thread')}>")
            if draw.random() < 0.6:
                put(draw.choice(("h2", "h3", "h4")), _sentence(draw, 1, 3), 0)
            for _ in range(draw.randint(1, 5)):
                put(draw.choice(("p", "div", "li")), _prose(draw), 0, draw.choice(("", ' class="comment"', ' class="reply"')))
            out.append(f"</{tag}>")

    if draw.random() < 0.08:  # a page of nothing but its text
        for _ in range(draw.randint(1, 6)):
            put("p", _prose(draw), 1)
        return f"<html><body>{''.join(out)}</body></html>", labels
    if draw.random() < 0.9:
        put("title", _sentence(draw, 2, 9), 0)
    if draw.random() < 0.5:
        out.append("<header>" if draw.random() < 0.6 else f"<div{named('header', 'masthead', 'top', 'logo')}>")
        closing = "</header>" if out[-1] == "<header>" else "</div>"
        put(draw.choice(("h1", "p", "div")), _sentence(draw, 1, 5), 0)
        if draw.random() < 0.5:
            side("menu")
        out.append(closing)
    for kind in ("menu", "advert", "notice", "form", "aside"):
        if draw.random() < (0.8 if kind == "menu" else 0.35):
            side(kind)
    shape = draw.choice(("<article>", "<article>", "<main>", "<main><article>", "<div>", ""))
    if shape == "<div>":
        shape = f"<div{named('content', 'article', 'post', 'entry', 'main', 'story', 'text')}>"
    out.append(shape)
    if draw.random() < 0.8:
        put(draw.choice(("h1", "h1", "h2")), _sentence(draw, 1, 9), 1)
    else:
        put("p", _prose(draw), 1)
    for _ in range(draw.choice((1, 2, 4, 6, 9))):
        kind = draw.random()
        if kind < 0.62:
            put("p", _prose(draw), 1)
        elif kind < 0.69:
            put(draw.choice(("h2", "h3")), _sentence(draw, 1, 6), 1)
        elif kind < 0.74:
            out.append(draw.choice(("<ul>", "<ol>")))
            closing = out[-1].replace("<", "</")
            for _ in range(draw.randint(1, 4)):
                put("li", _prose(draw), 1)
            out.append(closing)
        elif kind < 0.79:
            put(draw.choice(("blockquote", "pre", "div")), _prose(draw), 1)
        elif kind < 0.81:
            out.append("<table><tr>")
            put("th", _sentence(draw, 1, 2), 1)
            put("td", _sentence(draw, 1, 4), 1)
            out.append("</tr></table>")
        elif kind < 0.85:
            put("p", _prose(draw) + f' <a href="/y">{_sentence(draw, 1, 3)}</a>.', 1)
        else:
            side(draw.choice(("advert", "advert", "notice", "aside", "form")))
    if draw.random() < 0.2:
        side(draw.choice(("comments", "comments", "advert", "notice")))
    out.append("".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", shape))))
    for kind in ("comments", "aside", "notice", "form", "advert", "menu"):
        if draw.random() < (0.5 if kind == "comments" else 0.2):
            side(kind)
    if draw.random() < 0.85:
        tag, names = draw.choice((("footer", ""), ("footer", ""), ("div", named("footer", "bottom", "copyright", "legal"))))
        put(tag, "&copy; " + _prose(draw), 0, names)
    return f"<html><body>{''.join(out)}</body></html>", labels


@lru_cache(maxsize=1)
def trained(pages: int = TRAINING_PAGES, rounds: int = ROUNDS, seed: int = 7) -> Chain:
    """The model; pages whose blocks do not fit their labels would be an error."""
    draw = random.Random(seed)
    examples = []
    for _ in range(pages):
        html, labels = labelled_page(draw)
        own = [above + seen for above, seen in block_features(blocks(html))]
        if len(own) != len(labels):
            raise AssertionError("a labelled page's blocks and labels differ")
        examples.append((own, labels))
    model = Chain()
    model.train(examples, rounds)
    return model


def main_text(html: str, model: Chain, known: dict) -> str:
    """Text of the blocks that the model calls main text, joined by line ends."""
    page = blocks(html)
    if not page:
        return ""
    weights = model.weights
    scores = []
    for above, seen in block_features(page):
        score = known.get(above)
        if score is None:
            score = sum(weights.get(f, 0.0) for f in above)
            if len(known) < 100_000:
                known[above] = score
        scores.append(score + sum([weights.get(f, 0.0) for f in seen]))
    return "\n".join(text for (text, _, _), label in zip(page, model.best(scores)) if label)


def extract(pages: DataFrame, model: Chain | None = None) -> DataFrame:
    """One row per page: its main text and the text's code points.

    A null or empty page has an empty text, as has one without main text. Rows without an id or
    address are answered too, repeated rows each; an empty table gives no rows. Other
    columns are not looked at.
    """
    model = model or trained()
    rows = columns(pages, page_id="page_id", url="url", html="html")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            texts = [main_text(h.as_py() or "", model, known) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(of, f"page_id {kind}, url string, text string, n_chars bigint")
