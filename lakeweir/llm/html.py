"""Main text of web pages by a recurrent labeller of blocks.

A page becomes the sequence of its leaf blocks: runs of text between the tags
that begin or end a block, each with the path of elements around it. A
bidirectional LSTM reads the sequence in both directions, so every block is
labelled in the context of the whole page.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.common import text_slices
from lakeweir.llm.words import SPACE, words_of

#: Pages that the labeller is fitted to, at most.
FIT_PAGES = 240
#: Hashed tokens of paths and words, and the sizes of their vectors and of the states.
PATH_CODES, WORD_CODES = 1024, 512
PATH_SIZE, WORD_SIZE, STATE = 16, 8, 16
#: Blocks that one step of the network sees at most, over the pages of a batch.
STEP_BLOCKS = 20_000

# Elements of HTML by what they mean for blocks.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("script style template noscript svg canvas iframe object head".split())
#: Of these, what ends only at its own end tag, as its content is no HTML; and what a slash before ``>`` makes empty.
RAW = frozenset(["script", "style"])
MAY_BE_EMPTY = frozenset("script style svg canvas iframe object".split())
#: Stands in the path of elements for one of these whose end tag is missing, and for what is in it.
UNCLOSED, UNCLOSED_SVG = "-", "-svg"
HIDES = NO_TEXT | {UNCLOSED, UNCLOSED_SVG}
#: What may stand in a head; any other element ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: An opening tag of the key ends open elements of these names.
ENDS = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
} | {t: {"p"} for t in "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split()}
#: Elements that text is main text in, and those that it never is in: what the labels for fitting come from.
MAIN = frozenset(["article", "main"])
OTHER = frozenset("aside button fieldset footer form header label menu nav select textarea".split())
OTHER_NAMES = frozenset(
    "ad ads advert advertisement banner breadcrumb comment comments cookie disqus footer header login menu masthead "
    "nav navbar navigation newsletter notice popup promo related replies reply share sidebar social sponsored subscribe widget".split()
)

#: What main text has beside paragraphs.
_PARTS = [
    ("ul", "li"), ("ol", "li"), ("blockquote",), ("blockquote", "p"), ("table", "tr", "td"), ("table", "tbody", "tr", "td"), ("h2",), ("h3",),
    ("pre",), ("figure", "figcaption"), ("dl", "dd"), ("div", "p"), ("section", "p"),
]

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S)
_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW}
#: A slash at the end of an attribute's bare value is part of the value.
_CLOSES_ITSELF = re.compile(r"(?<!/)/\s*\Z")
_BARE_VALUE = re.compile(r"""=\s*[^\s"'>]*/\s*\Z""")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


@lru_cache(maxsize=20_000)
def _names(tag: str, attributes: str) -> tuple[str, ...]:
    """The tokens of one element of a path: its tag, and the words of its class, id and role."""
    found = (a or b or c for a, b, c in _NAMES.findall(attributes))
    return (tag, *("." + w for value in found for w in re.split(r"[^a-z0-9]+", value.lower()) if w))


@dataclass
class Blocks:
    """The leaf blocks of one page, in order: ``texts``, their ``paths``, and the share of their text in links."""

    texts: list[str]
    paths: list[tuple[str, ...]]
    linked: list[float]


def blocks_of(html: str) -> Blocks:
    """Cut a page into its leaf blocks.

    Character references are decoded and white space inside a block becomes one
    space. Elements that hold no text for readers are left out whole. Tags that
    are never closed end where another element ends them: a head at the first
    element or text that cannot stand in one, an svg at the first block, others
    without text with their parent, and scripts and styles, which hold no tags,
    at the end of the page.
    """
    out = Blocks([], [], [])
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []
    in_links = 0

    def flush():
        nonlocal in_links
        raw = "".join(held)
        text = " ".join((unescape(raw) if "&" in raw else raw).split())
        if text:
            out.texts.append(text)
            out.paths.append(tuple(n for tag, names in stack if tag not in INLINE for n in names))
            out.linked.append(min(1.0, in_links / max(1, len(raw))))
        held.clear()
        in_links = 0

    def text(value: str):
        nonlocal in_links
        if value.strip() and stack and stack[-1][0] == "head":
            del stack[-1]
        if any(tag in HIDES for tag, _ in stack):
            return
        held.append(value)
        if any(tag == "a" for tag, _ in stack):
            in_links += len(value)

    def is_closed(tag: str, after: int) -> bool:
        if tag not in last_ends:
            last_ends[tag] = max((m.start() for m in re.finditer(rf"</{tag}(?=[\s/>])", html, re.I)), default=-1)
        return last_ends[tag] >= after

    last_ends: dict[str, int] = {}
    last = 0
    while token := _TOKEN.search(html, last):
        if token.start() > last:
            text(html[last : token.start()])
        last = token.end()
        tag = (token.group(2) or "").lower()
        if not tag:
            continue
        opens, attributes = not token.group(1), token.group(3)
        if opens:
            hidden = next((i for i, (t, _) in enumerate(stack) if t in HIDES), None)
            if hidden is not None and (stack[hidden][0] == "head" and tag not in IN_HEAD and len(stack) - 1 <= hidden + (stack[-1][0] == "title") or stack[hidden][0] == UNCLOSED_SVG and tag in ENDS):
                del stack[hidden:]
        empty = tag in MAY_BE_EMPTY and _CLOSES_ITSELF.search(attributes) and not _BARE_VALUE.search(attributes)
        if tag in RAW or opens and empty:
            flush()
            if opens and not empty:
                end = _RAW_ENDS[tag].search(html, last)
                last = end.end() if end else len(html)
            continue
        if tag == "br":
            held.append(" ")
        elif tag in INLINE:
            if opens:
                stack.append((tag, (tag,)))
            else:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        stack[i:] = [x for x in stack[i + 1 :] if x[0] not in (UNCLOSED, UNCLOSED_SVG)]
                        break
                    if stack[i][0] not in INLINE and stack[i][0] not in (UNCLOSED, UNCLOSED_SVG):
                        break
        else:
            flush()
            if not opens:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
            else:
                ends = ENDS.get(tag, ())
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ends:
                        del stack[i:]
                    elif stack[i][0] not in INLINE and stack[i][0] not in ("dl", "ul", "ol", UNCLOSED, UNCLOSED_SVG) + tuple(ends):
                        break
                if stack and stack[-1][0] in (UNCLOSED, UNCLOSED_SVG):
                    continue
                if tag in NO_TEXT and tag != "head" and not is_closed(tag, last):
                    stack.append((UNCLOSED_SVG if tag == "svg" else UNCLOSED, ()))
                elif tag not in VOID:
                    stack.append((tag, _names(tag, attributes)))
    if last < len(html):
        text(html[last:])
    flush()
    return out


def weak_label(path: tuple[str, ...]) -> bool | None:
    """Whether a path names main text; None where it says nothing."""
    if any(n in OTHER or n[0] == "." and n[1:] in OTHER_NAMES for n in path):
        return False
    return True if any(n in MAIN for n in path) else None


def _codes(path: tuple[str, ...]) -> np.ndarray:
    """Hashed tokens of a path; those next to the text count as themselves and by their place."""
    tokens = [*path, *(f"{n}^{i}" for i, n in enumerate(reversed(path)) if i < 3)]
    return np.array([zlib.crc32(t.encode()) % PATH_CODES for t in tokens] or [0])


class Features:
    """What the network reads of a list of pages: numbers, path tokens and words of all blocks."""

    def __init__(self, pages: list[Blocks]):
        self.lengths = np.array([len(p.texts) for p in pages])
        texts = [t for p in pages for t in p.texts]
        paths = [x for p in pages for x in p.paths]
        known: dict[tuple[str, ...], int] = {}
        self.path_of = np.array([known.setdefault(x, len(known)) for x in paths], np.int64)
        self.paths = [_codes(x) for x in known]
        words = words_of(pa.array(texts, pa.string()), SPACE)
        self.words = (words.hashes % np.uint64(WORD_CODES)).astype(np.int64)
        self.word_starts = words.starts
        counts = np.diff(words.starts)
        size = np.array([len(t) for t in texts], float)
        ends = np.array([t[-1] in ".!?…。！？" for t in texts], float)
        linked = np.array([x for p in pages for x in p.linked], float)
        page = np.repeat(np.arange(len(pages)), self.lengths)
        place = (np.arange(len(texts)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)) / np.maximum(1, self.lengths[page])
        self.numbers = np.stack([np.log1p(counts) / 4, np.log1p(size) / 6, ends, linked, place, np.ones(len(texts))], axis=1) if texts else np.zeros((0, 6))

    def inputs(self, path_vectors: np.ndarray, word_vectors: np.ndarray) -> np.ndarray:
        n = len(self.numbers)
        if not n:
            return np.zeros((0, PATH_SIZE + WORD_SIZE + 6))
        means = np.stack([path_vectors[c].mean(axis=0) for c in self.paths])
        counts = np.diff(self.word_starts)
        words = np.add.reduceat(word_vectors[self.words], self.word_starts[:-1], axis=0) / counts[:, None]
        return np.concatenate((means[self.path_of], words, self.numbers), axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Lstm:
    """One direction of the network, over padded sequences ``(time, page, input)``."""

    def __init__(self, inputs: int, rng: np.random.Generator):
        self.w = rng.normal(0, 0.25, (inputs + STATE, 4 * STATE))
        self.b = np.zeros(4 * STATE)
        self.b[STATE : 2 * STATE] = 1.0

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        steps, pages, _ = x.shape
        h, c = np.zeros((pages, STATE)), np.zeros((pages, STATE))
        out, kept = np.zeros((steps, pages, STATE)), []
        projected = x @ self.w[: x.shape[2]] + self.b
        u = self.w[x.shape[2] :]
        for t in range(steps):
            z = projected[t] + h @ u
            i, f, o = (_sigmoid(z[:, k * STATE : (k + 1) * STATE]) for k in range(3))
            g = np.tanh(z[:, 3 * STATE :])
            m = mask[t][:, None]
            c_new = m * (f * c + i * g) + (1 - m) * c
            h_new = m * (o * np.tanh(c_new)) + (1 - m) * h
            if keep:
                kept.append((h, c, i, f, o, g, c_new))
            h, c = h_new, c_new
            out[t] = h
        return out, kept

    def backward(self, x: np.ndarray, mask: np.ndarray, kept: list, d_out: np.ndarray):
        """Gradients of the weights, the biases and the inputs."""
        n_in = x.shape[2]
        dw, db, dx = np.zeros_like(self.w), np.zeros_like(self.b), np.zeros_like(x)
        dh, dc = np.zeros_like(d_out[0]), np.zeros_like(d_out[0])
        for t in range(len(x) - 1, -1, -1):
            h, c, i, f, o, g, c_new = kept[t]
            m = mask[t][:, None]
            dh = dh + d_out[t]
            tanh_c = np.tanh(c_new)
            inner = dc + m * dh * o * (1 - tanh_c**2)
            dz = m * np.concatenate((inner * g * i * (1 - i), inner * c * f * (1 - f), dh * tanh_c * o * (1 - o), inner * i * (1 - g**2)), axis=1)
            dw[:n_in] += x[t].T @ dz
            dw[n_in:] += h.T @ dz
            db += dz.sum(axis=0)
            dx[t] = dz @ self.w[:n_in].T
            dh = dz @ self.w[n_in:].T + (1 - m) * dh
            dc = m * inner * f + (1 - m) * dc
        return dw, db, dx


class Labeller:
    """The bidirectional network: vectors of paths and words, two directions, and one output per block."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        n_in = PATH_SIZE + WORD_SIZE + 6
        self.path_vectors = rng.normal(0, 0.4, (PATH_CODES, PATH_SIZE))
        self.word_vectors = rng.normal(0, 0.2, (WORD_CODES, WORD_SIZE))
        self.ahead, self.back = Lstm(n_in, rng), Lstm(n_in, rng)
        self.out = rng.normal(0, 0.2, 2 * STATE + n_in)

    @staticmethod
    def padded(x: np.ndarray, lengths: np.ndarray):
        """Sequences side by side, and the same from their ends: ``(x, reversed, mask, place of each block)``."""
        steps, pages = int(lengths.max(initial=0)), len(lengths)
        page = np.repeat(np.arange(pages), lengths)
        time = np.arange(len(x)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        mask = np.zeros((steps, pages))
        mask[time, page] = 1
        there, back = np.zeros((steps, pages, x.shape[1])), np.zeros((steps, pages, x.shape[1]))
        there[time, page] = x
        back[lengths[page] - 1 - time, page] = x
        return there, back, mask, time, page

    def score(self, features: Features) -> np.ndarray:
        """The log-odds of each block being main text."""
        x = features.inputs(self.path_vectors, self.word_vectors)
        out = np.zeros(len(x))
        starts = np.cumsum(features.lengths) - features.lengths
        # Pages of like length go through together, so that little is padding.
        order = np.argsort(features.lengths, kind="stable")
        order = order[features.lengths[order] > 0]
        while len(order):
            room = np.maximum(1, STEP_BLOCKS // features.lengths[order])
            n = int(np.searchsorted(np.arange(1, len(order) + 1) > room, True))
            chosen, order = order[: max(1, n)], order[max(1, n) :]
            at = np.concatenate([np.arange(starts[p], starts[p] + features.lengths[p]) for p in chosen])
            out[at] = self._run(x[at], features.lengths[chosen])[0]
        return out

    def _run(self, x: np.ndarray, lengths: np.ndarray, keep: bool = False):
        there, back, mask, time, page = self.padded(x, lengths)
        a, kept_a = self.ahead.forward(there, mask, keep)
        b, kept_b = self.back.forward(back, mask, keep)
        h = np.concatenate((a[time, page], b[lengths[page] - 1 - time, page], x), axis=1)
        return h @ self.out, (there, back, mask, time, page, kept_a, kept_b, h)

    def fit(self, batches: list[tuple[Features, np.ndarray]], rounds: int = 6, rate: float = 0.01):
        """Adam on the cross entropy of the labelled blocks; labels are 1, 0, or -1 for unknown."""
        names = ["path_vectors", "word_vectors", "out"]
        parts = [(self, n) for n in names] + [(self.ahead, "w"), (self.ahead, "b"), (self.back, "w"), (self.back, "b")]
        first, second, step = [0.0] * len(parts), [0.0] * len(parts), 0
        for _ in range(rounds):
            for features, labels in batches:
                x = features.inputs(self.path_vectors, self.word_vectors)
                logits, (there, back, mask, time, page, kept_a, kept_b, h) = self._run(x, features.lengths, keep=True)
                known = labels >= 0
                d = np.where(known, _sigmoid(logits) - labels, 0) / max(1, known.sum())
                dh = d[:, None] * self.out
                da, db = np.zeros((*mask.shape, STATE)), np.zeros((*mask.shape, STATE))
                da[time, page] = dh[:, :STATE]
                end = features.lengths[page] - 1 - time
                db[end, page] = dh[:, STATE : 2 * STATE]
                wa, ba, xa = self.ahead.backward(there, mask, kept_a, da)
                wb, bb, xb = self.back.backward(back, mask, kept_b, db)
                dx = dh[:, 2 * STATE :] + xa[time, page] + xb[end, page]
                d_path, d_word = np.zeros_like(self.path_vectors), np.zeros_like(self.word_vectors)
                by_path = np.zeros((len(features.paths), PATH_SIZE))
                np.add.at(by_path, features.path_of, dx[:, :PATH_SIZE])
                for codes, g in zip(features.paths, by_path, strict=True):
                    np.add.at(d_path, codes, g / len(codes))
                counts = np.diff(features.word_starts)
                np.add.at(d_word, features.words, np.repeat(dx[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] / counts[:, None], counts, axis=0))
                step += 1
                for k, ((owner, name), g) in enumerate(zip(parts, (d_path, d_word, h.T @ d, wa, ba, wb, bb), strict=True)):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    value = getattr(owner, name)
                    value -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)


def _rearranged(page: Blocks, labels: list, rng: np.random.Generator, spare: list[str]) -> tuple[Blocks, np.ndarray]:
    """The page's blocks in a layout drawn at random, so that no single layout is learned.

    Main text moves to other containers; menus, notices, adverts, sidebars,
    forms, comments and footers come around it, some as long as main text.
    """
    pick = lambda options: options[int(rng.integers(len(options)))]
    words = lambda n: " ".join(pick(spare).split()[:n]) or "more"
    main = [(t, p, s) for t, p, s, y in zip(page.texts, page.paths, page.linked, labels, strict=True) if y == 1]
    shell = pick([(), ("div", ".wrapper"), ("div", ".page", ".site"), ("div", "#app")])
    body = ("html", "body", *shell)
    home = pick([("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".post", ".entry"), ("section", ".story"), ("article", ".post"), ("div", ".article", ".body"), ("div",), (), ("table", "tr", "td")])
    rows: list[tuple[str, tuple[str, ...], float, int]] = []

    def add(n, path, length, linked):
        for _ in range(n):
            rows.append((words(length), (*body, *path), linked, 0))

    def sides():
        some = lambda p: rng.random() < p
        if some(0.3):
            add(1, pick([("div", ".notice"), ("div", ".cookie", ".banner"), ("p", ".notice"), ("div", ".alert")]), 12, 0.1)
        if some(0.4):
            add(1, pick([("div", ".ad"), ("div", ".advert"), ("div", ".promo"), ("aside", ".sponsored"), ("div", ".banner")]), int(rng.integers(3, 40)), 0.0)
        if some(0.3):
            add(int(rng.integers(1, 6)), pick([("aside",), ("div", ".sidebar"), ("aside", ".related"), ("div", ".widget"), ("aside", "ul", "li")]), int(rng.integers(2, 30)), float(rng.random()))
        if some(0.2):
            add(int(rng.integers(1, 4)), pick([("form", "label"), ("form",), ("form", ".search", "button"), ("form", "div"), ("form", ".subscribe", "p")]), 6, 0.0)

    if rng.random() < 0.6:
        add(1, pick([("header",), ("header", "div"), ("div", ".header"), ("header", "h1"), ("div", ".masthead")]), 5, 0.4)
    if rng.random() < 0.8:
        add(int(rng.integers(2, 9)), pick([("nav", "ul", "li"), ("ul", ".menu", "li"), ("div", ".nav"), ("nav",), ("header", "nav", "ul", "li"), ("table", "tr", "td")]), 2, 1.0)
    sides()
    for n, (text, path, linked) in enumerate(main):
        leaf = (next((x for x in reversed(path) if x[0] not in ".#" and x not in MAIN), "p"),)
        if n == 0 and rng.random() < 0.3:
            leaf = ("header", "h1")
        rows.append((text, (*body, *home, *leaf), linked, 1))
        if rng.random() < 0.15:  # lists, quotes, tables and headings belong to the text around them
            kind = pick(_PARTS)
            for _ in range(int(rng.integers(1, 6))):
                rows.append((words(int(rng.integers(1, 25))), (*body, *home, *kind), float(rng.random() < 0.1), 1))
        if n and rng.random() < 0.04:
            add(1, (*home, *pick([("div", ".ad"), ("aside",), ("div", ".share"), ("figure", ".promo"), ("div", ".newsletter")])), 12, 0.2)
    inside = home if rng.random() < 0.3 else ()
    if rng.random() < 0.5:
        kind = pick([("section", ".comments"), ("div", ".comments"), ("div", ".comment", ".list"), ("section", "#comments", ".comments", "div", ".comment"), ("ol", ".comments", "li", ".comment"), ("section", ".respond"), ("div", ".responses")])
        add(int(rng.integers(1, 8)), (*inside, *kind, "p"), int(rng.integers(4, 90)), 0.0)
    sides()
    if rng.random() < 0.9:
        add(int(rng.integers(1, 3)), pick([("footer",), ("footer", "p"), ("div", ".footer"), ("div", ".footer", "p"), ("div", ".foot", "p"), ("div", ".bottom")]), 12, 0.2)
    texts, paths, linked, labels = zip(*rows, strict=True) if rows else ((), (), (), ())
    return Blocks(list(texts), list(paths), list(linked)), np.array(labels)


def train(htmls: list[str], seed: int = 7) -> Labeller:
    """Fit a labeller to a list of pages.

    Labels come from the pages' own semantic elements (:func:`weak_label`). Each
    page is learned as it is and in layouts drawn at random.
    """
    rng = np.random.default_rng(seed)
    pages = [p for p in map(blocks_of, htmls) if p.texts]
    spare = [t for p in pages for t in p.texts] or ["more"]
    learned = []
    for page in pages:
        labels = [{True: 1, False: 0, None: -1}[weak_label(path)] for path in page.paths]
        learned.append((page, np.array(labels)))
        for _ in range(2):
            again = _rearranged(page, labels, rng, spare)
            if again[0].texts:
                learned.append(again)
    learned.sort(key=lambda x: len(x[0].texts))
    groups = [learned[i : i + 16] for i in range(0, len(learned), 16)]
    batches = [(Features([p for p, _ in g]), np.concatenate([y for _, y in g])) for g in groups]
    labeller = Labeller(seed)
    labeller.fit([batches[i] for i in rng.permutation(len(batches))])
    return labeller


def main_blocks(page: Blocks, scores: np.ndarray) -> np.ndarray:
    """Which blocks are main text: those above 0, or, if there are none, all that nothing speaks against."""
    chosen = scores > 0
    if chosen.any():
        return chosen
    return np.array([weak_label(p) is not False and linked < 0.5 for p, linked in zip(page.paths, page.linked, strict=True)], bool)


def _sample(named: DataFrame) -> list[str]:
    """The different pages with the least hashes. Hashes are sorted out first: no other page leaves its task."""
    hashed = named.where("html IS NOT NULL").select("html", F.xxhash64("html").alias("hash"))
    least = [r["hash"] for r in hashed.select("hash").distinct().orderBy("hash").limit(FIT_PAGES).collect()]
    some = hashed.where(F.col("hash").isin(least)).groupBy("hash").agg(F.min("html").alias("html"))
    return [r["html"] for r in sorted(some.collect(), key=lambda r: r["hash"])]


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)``: the main text of each page.

    Blocks that the labeller takes for main text are joined in page order by one
    space; on a page without such a block, those outside menus, forms and the
    like that are no links. A null or empty page has the empty text, as has one
    where nothing is left. The labeller is fitted to at most :data:`FIT_PAGES`
    different pages, those with the least hash of their html; every page is read whole. Repeated rows each
    give one; other columns are not read.
    """
    named = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    labeller = train(_sample(named))
    shared = pages.sparkSession.sparkContext.broadcast(labeller)

    def work(batches):
        for batch in batches:
            for part in text_slices(batch, "html"):
                cut = [blocks_of(h or "") for h in part.column("html").to_pylist()]
                main = shared.value.score(Features(cut))
                texts, at = [], 0
                for page in cut:
                    chosen = main_blocks(page, main[at : at + len(page.texts)])
                    at += len(page.texts)
                    texts.append(" ".join(t for t, ok in zip(page.texts, chosen, strict=True) if ok))
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    kinds = {c: named.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return named.mapInArrow(work, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
