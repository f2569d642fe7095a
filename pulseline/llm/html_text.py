"""Main-text extraction by a recurrent block labeller (operator 10).

A page is read as its sequence of text blocks (the leaves of the block
elements). Each block becomes a vector of its hashed tag path, its hashed
words and a few densities; a bidirectional LSTM in numpy reads the whole
sequence, so every block is classified with the page around it. The blocks
labelled main text are joined in page order.

The labeller is trained on a bounded sample of the given pages. Its labels
come from the containers the pages declare themselves (article, main, nav,
footer, …). While training, declared containers are often swapped for others
of the same sense or hidden, so that words, densities and neighbours count
too.

Defined results: a null or empty page, and one without text, give an empty
text. Without a page that declares its main part nothing can be learned and
all blocks are kept. Unclosed elements end with the page, or where HTML ends
them: a head before the first text or element that cannot stand in it. An
unfinished tag at the end is dropped. An unfinished character reference stays as it is.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseline.llm.common import arrow_udf, text_bytes
from pulseline.llm.textstats import word_bounds, word_hashes

# pages the labeller is trained on, and characters of one, at most
SAMPLE = 320
SAMPLE_CHARS = 60_000
PATH_SLOTS, WORD_SLOTS, SCALARS, HIDDEN = 64, 48, 8, 16
TRAIN_CELLS = 12_800  # blocks, with padding, in memory at once while training
CELLS = 100_000  # blocks, with padding, labelled together (a longer page goes alone)
DEPTH = 256      # elements nested deeper count as their ancestor
THRESHOLD = 0.5

# elements whose content is never text of the page
HIDDEN_TAGS = frozenset("script style noscript template svg math head title iframe object "
                        "canvas select option textarea button audio video map".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd "
                   "label mark meta link q rp rt ruby s samp small source span strike strong sub sup time track "
                   "tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# what can stand in a head; any other start tag, or text, ends it
IN_HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
# start tags that end an open element whose content is hidden
ENDS = {"button": "button", **dict.fromkeys(("select", "input", "keygen", "textarea"), "select")}
OPTIONS = {"option": ("option",), "optgroup": ("option", "optgroup")}
TABLE_PARTS = frozenset("caption table tbody td tfoot th thead tr".split())
# words of container names, by sense: the labels' only prior knowledge
MAIN_WORDS = ("article", "main", "content", "post", "entry", "story", "body-text")
OTHER_WORDS = ("nav", "menu", "header", "footer", "aside", "sidebar", "ad", "ads", "advert", "sponsor", "promo",
               "banner", "cookie", "notice", "form", "comments", "comment", "share", "social", "related",
               "breadcrumb", "subscribe", "newsletter", "widget")
_OTHER = frozenset(OTHER_WORDS)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|textarea|title)\b(?:[^>]*)>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>(?:[^>\"']|\"[^\"]*\"|'[^']*')*))>"
    r"|<[/!?][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*(?:>|\Z)"
    r"|([^<]+|<)", re.S | re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Block:
    path: tuple[str, ...]   # tags and words of class, id and role, outermost first
    text: str
    linked: int             # characters inside links


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    path: tuple[str, ...] = ()
    parts: list[str] = []
    linked, in_link, hidden = 0, 0, 0
    past_head = False  # a page has one head, before all else
    deep: list[str] = []  # open elements below DEPTH: not in the path, but ended like others
    held: Counter[str] = Counter()
    select_in_table = False

    def is_open(tag: str) -> bool:
        return held[tag] > 0 or any(t == tag for t, _ in stack)

    def top() -> str:
        return deep[-1] if deep else stack[-1][0] if stack else ""

    def end_element(tag: str) -> None:
        nonlocal hidden, path
        while deep or stack:
            if deep:
                t = deep.pop()
                held[t] -= 1
            else:
                t, _ = stack.pop()
            hidden -= t in HIDDEN_TAGS
            if t == tag:
                break
        path = tuple(w for _, names in stack for w in names)

    def ends_before(tag: str) -> None:
        """End what the start tag ``tag`` (or a text, "") cannot stand in."""
        nonlocal past_head
        if tag not in IN_HEAD:
            past_head = True
            if top() == "head":
                end_element("head")
        if not hidden:
            return
        while top() in OPTIONS.get(tag, ()):
            end_element(top())
        if tag in ENDS and is_open(ENDS[tag]):
            end_element(ENDS[tag])
        if tag in TABLE_PARTS and select_in_table and is_open("select"):
            end_element("select")

    def close() -> None:
        nonlocal parts, linked
        if parts:
            text = "".join(parts)
            if "&" in text:
                text = html.unescape(text)
            text = " ".join(text.split())
            if text:
                out.append(Block(path, text, linked))
            parts, linked = [], 0

    for m in _TOKEN.finditer(page):
        content = m.group(5)
        if content is not None:
            if (hidden or not past_head) and content.strip(" \t\n\r\f\ufeff"):
                ends_before("")
            if not hidden:
                parts.append(content)
                if in_link:
                    linked += len(content)
            continue
        tag = m.group(3)
        if tag is None:  # comment, raw element, declaration or unfinished tag
            if m.group(1):
                ends_before(m.group(1).lower())
            continue
        tag = tag.lower()
        end = m.group(2)
        if not end:
            # a second head or html means nothing, a select in a select is an end tag
            ignored = tag == "head" and past_head or tag in ("html", "select") and is_open(tag)
            ends_before(tag)
            past_head |= tag == "head"
            if ignored:
                close()
                continue
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if end else 1
            elif tag == "br":
                parts.append(" ")
            continue
        close()
        if end:
            if is_open(tag):
                end_element(tag)
        else:
            if top() == "p" or top() == tag and tag in ("li", "dt", "dd", "tr", "td", "th"):
                end_element(top())
            if tag in VOID or m.group(4).endswith("/"):
                path = tuple(w for _, names in stack for w in names)
                continue
            names = [tag]
            if m.group(4):
                for a, b, c in _NAMES.findall(m.group(4)):
                    names += _WORD.findall((a or b or c).lower())
            if tag == "select":
                select_in_table = is_open("table")
            if len(stack) < DEPTH:
                stack.append((tag, tuple(names)))
            else:
                deep.append(tag)
                held[tag] += 1
            hidden += tag in HIDDEN_TAGS
        path = tuple(w for _, names in stack for w in names)
        in_link = 0
    close()
    return out


def declared(block: Block) -> int | None:
    """What the page's own containers say: 1 main, 0 other; innermost sense first."""
    for word in reversed(block.path):
        if word in _OTHER:
            return 0
        if word in ("article", "main"):
            return 1
    return None


_SLOTS: dict[str, int] = {}


def _slot(word: str) -> int:
    if word not in _SLOTS:
        if len(_SLOTS) > 100_000:
            _SLOTS.clear()
        value = 2166136261
        for c in word.encode():
            value = (value ^ c) * 16777619 & 0xFFFFFFFF
        _SLOTS[word] = (value ^ value >> 15) % PATH_SLOTS
    return _SLOTS[word]


def vectors(pages: list[list[Block]]) -> np.ndarray:
    """Feature rows of all blocks of all pages, in order."""
    blocks = [b for page in pages for b in page]
    n = len(blocks)
    x = np.zeros((n, PATH_SLOTS + WORD_SLOTS + SCALARS), np.float32)
    if not n:
        return x
    for i, b in enumerate(blocks):
        for word in b.path:
            x[i, _slot(word)] = 1.0
    raw, offsets = text_bytes(pa.array([b.text for b in blocks], pa.large_string()))
    starts, ends, first = word_bounds(raw, offsets)
    words = np.diff(first)
    slot = (word_hashes(raw, starts, ends) >> np.uint64(40)).astype(np.int64) % WORD_SLOTS
    row = np.repeat(np.arange(n), words)
    tally = np.bincount(row * WORD_SLOTS + slot, minlength=n * WORD_SLOTS).reshape(n, WORD_SLOTS)
    x[:, PATH_SLOTS:PATH_SLOTS + WORD_SLOTS] = tally / np.maximum(words, 1)[:, None]
    size = np.array([len(b.text) for b in blocks], float)
    share = lambda chars: np.diff(np.concatenate([[0], np.cumsum(np.isin(raw, list(chars)))])[offsets]) / np.maximum(size, 1)
    place = np.concatenate([np.arange(len(p)) / max(len(p), 1) for p in pages])
    at = PATH_SLOTS + WORD_SLOTS
    x[:, at] = np.log1p(words) / 4
    x[:, at + 1] = np.minimum([b.linked for b in blocks] / np.maximum(size, 1), 1)
    x[:, at + 2] = size / np.maximum(words, 1) / 10
    x[:, at + 3] = share(b".,;:!?") * 5
    x[:, at + 4] = share(b"0123456789")
    x[:, at + 5] = share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    x[:, at + 6] = place
    x[:, at + 7] = [len(b.path) / 16 for b in blocks]
    return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _lstm(pre: np.ndarray, u: np.ndarray):
    """States of one direction. ``pre`` (steps, pages, 4H): input part of the gates."""
    t, b, h = pre.shape[0], pre.shape[1], u.shape[0]
    hs, cs = np.zeros((t + 1, b, h), pre.dtype), np.zeros((t + 1, b, h), pre.dtype)
    gates = np.empty((t, b, 4 * h), pre.dtype)
    for k in range(t):
        z = pre[k] + hs[k] @ u
        gates[k, :, :3 * h] = _sigmoid(z[:, :3 * h])
        gates[k, :, 3 * h:] = np.tanh(z[:, 3 * h:])
        i, f, o, g = (gates[k, :, j * h:(j + 1) * h] for j in range(4))
        cs[k + 1] = f * cs[k] + i * g
        hs[k + 1] = o * np.tanh(cs[k + 1])
    return hs, cs, gates


def _lstm_back(dh: np.ndarray, u: np.ndarray, hs, cs, gates) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of ``pre`` and ``u`` given those of the states."""
    t, b, h = dh.shape
    dpre, du = np.zeros_like(gates), np.zeros_like(u)
    later_h, later_c = np.zeros((b, h)), np.zeros((b, h))
    for k in range(t - 1, -1, -1):
        i, f, o, g = (gates[k, :, j * h:(j + 1) * h] for j in range(4))
        tc = np.tanh(cs[k + 1])
        d = dh[k] + later_h
        dc = later_c + d * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * cs[k] * f * (1 - f), d * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        dpre[k] = dz
        du += hs[k].T @ dz
        later_h, later_c = dz @ u.T, dc * f
    return dpre, du


@dataclass(frozen=True)
class Model:
    """Weights; empty where nothing could be learned."""
    weights: dict[str, np.ndarray]


def _flip(lengths: np.ndarray, steps: int) -> np.ndarray:
    """Step order that reverses every page within its own length (padding stays)."""
    k = np.arange(steps)[:, None]
    return np.where(k < lengths, lengths - 1 - k, k)


def _grid(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows of consecutive pages as (steps, pages, features), zero padded."""
    out = np.zeros((int(lengths.max()), len(lengths), x.shape[1]), x.dtype)
    page = np.repeat(np.arange(len(lengths)), lengths)
    step = np.arange(len(x)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[step, page] = x
    return out


def _forward(w: dict[str, np.ndarray], x: np.ndarray, lengths: np.ndarray):
    order, pages = _flip(lengths, len(x)), np.arange(len(lengths))[None, :]
    back_x = x[order, pages]
    a = _lstm(x @ w["wf"] + w["bf"], w["uf"])
    b = _lstm(back_x @ w["wb"] + w["bb"], w["ub"])
    states = np.concatenate([a[0][1:], b[0][1:][order, pages]], axis=2)
    return states @ w["v"] + w["c"], states, a, b, back_x, order


def probabilities(model: Model, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Probability of main text for all blocks of consecutive pages (no page empty)."""
    z = _forward(model.weights, _grid(x, lengths), lengths)[0]
    page = np.repeat(np.arange(len(lengths)), lengths)
    step = np.arange(len(x)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return _sigmoid(z[step, page])


def _varied(pages: list[list[Block]], labels: list[np.ndarray], rng) -> list[list[Block]]:
    """Pages with containers swapped for others of the same sense, or hidden."""
    out = []
    for page, label in zip(pages, labels):
        way = rng.random()
        if way < 0.4:
            out.append(page)
            continue
        main, seen = str(rng.choice(MAIN_WORDS)), {}
        new = []
        for block, y in zip(page, label):
            if way < 0.65:
                names = block.path[-1:] if block.path and block.path[-1] not in _OTHER | {"article", "main"} else ("div",)
            else:
                last = block.path[-1:] if y else ("p",)
                names = ("html", "body", "div", main if y else seen.setdefault(block.path, str(rng.choice(OTHER_WORDS))), *last)
            new.append(Block(tuple(names), block.text, block.linked))
        out.append(new)
    return out


def _bounded(part: np.ndarray, sizes: list[int]) -> list[list[int]]:
    """Pages of a batch in runs of at most TRAIN_CELLS padded blocks (a longer page alone)."""
    if max(sizes[i] for i in part) * len(part) <= TRAIN_CELLS:
        return [part.tolist()]
    out: list[list[int]] = []
    for i in sorted(part.tolist(), key=lambda i: -sizes[i]):  # a run is padded to its first page
        if out and sizes[out[-1][0]] * (len(out[-1]) + 1) <= TRAIN_CELLS:
            out[-1].append(i)
        else:
            out.append([i])
    return out


def _gradients(w: dict[str, np.ndarray], pages: list[list[Block]], labels: list[np.ndarray], total: int) -> dict[str, np.ndarray]:
    """Gradients of the mean loss over ``total`` blocks, these pages' part of it."""
    h = HIDDEN
    lengths = np.array([len(p) for p in pages])
    x = _grid(vectors(pages).astype(np.float64), lengths)
    y = _grid(np.concatenate(labels).astype(np.float64)[:, None], lengths)[:, :, 0]
    live = np.arange(len(x))[:, None] < lengths
    z, states, a, b, back_x, order = _forward(w, x, lengths)
    dz = np.where(live, _sigmoid(z) - y, 0) / total
    cols = np.arange(len(pages))[None, :]
    ds = dz[:, :, None] * w["v"]
    dpf, duf = _lstm_back(ds[:, :, :h], w["uf"], *a)
    dpb, dub = _lstm_back(ds[:, :, h:][order, cols], w["ub"], *b)
    flat = lambda q: q.reshape(-1, q.shape[-1])
    return {"wf": flat(x).T @ flat(dpf), "wb": flat(back_x).T @ flat(dpb), "uf": duf, "ub": dub,
            "bf": flat(dpf).sum(0), "bb": flat(dpb).sum(0), "v": flat(states).T @ dz.ravel(), "c": dz.sum()}


def learn(pages: list[str], epochs: int = 14, seed: int = 5, rate: float = 0.01) -> Model:
    """Train on the pages that declare both main and other blocks."""
    known, labels = [], []
    for page in pages:
        found = blocks_of(page)
        y = np.array([declared(b) or 0 for b in found])
        if len(found) and any(declared(b) == 1 for b in found):
            known.append(found)
            labels.append(y)
    if not known:
        return Model({})
    rng = np.random.default_rng(seed)
    d, h = PATH_SLOTS + WORD_SLOTS + SCALARS, HIDDEN
    w = {"wf": rng.normal(0, 0.15, (d, 4 * h)), "wb": rng.normal(0, 0.15, (d, 4 * h)),
         "uf": rng.normal(0, 0.2, (h, 4 * h)), "ub": rng.normal(0, 0.2, (h, 4 * h)),
         "bf": np.zeros(4 * h), "bb": np.zeros(4 * h), "v": rng.normal(0, 0.2, 2 * h), "c": np.zeros(())}
    w["bf"][h:2 * h] = w["bb"][h:2 * h] = 1.0
    mean, square = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    steps = 0
    for _ in range(epochs):
        varied = _varied(known, labels, rng)
        for part in np.array_split(rng.permutation(len(known)), -(-len(known) // 32)):
            grad = {k: np.zeros_like(v) for k, v in w.items()}
            total = sum(len(varied[i]) for i in part)
            for few in _bounded(part, [len(p) for p in varied]):
                for k, g in _gradients(w, [varied[i] for i in few], [labels[i] for i in few], total).items():
                    grad[k] = grad[k] + g
            steps += 1
            for k, g in grad.items():  # Adam
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                w[k] = w[k] - rate * (mean[k] / (1 - 0.9**steps)) / (np.sqrt(square[k] / (1 - 0.999**steps)) + 1e-8)
    return Model({k: v.astype(np.float32) for k, v in w.items()})


def fit(pages: DataFrame, rows: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Model:
    """Train on at most ``rows`` pages of at most ``chars`` characters, chosen by a hash of the page."""
    page = F.col("html").cast("string")
    found = (pages.select(page.alias("html")).filter(F.length("html").between(1, chars))
                  .orderBy(F.xxhash64("html"), "html").limit(rows).toArrow())
    return learn(found.column("html").to_pylist())


def main_texts(model: Model, pages: list[str]) -> list[str]:
    """The main text of every page."""
    parsed = [blocks_of(p) if p else [] for p in pages]
    keep: list[list[bool]] = [[True] * len(p) for p in parsed]
    if model.weights:
        order = sorted((i for i in range(len(parsed)) if parsed[i]), key=lambda i: len(parsed[i]))
        while order:  # longest first, so a batch is padded to its first page
            count = max(1, CELLS // len(parsed[order[-1]]))
            part, order = order[-count:], order[:-count]
            lengths = np.array([len(parsed[i]) for i in part])
            p = probabilities(model, vectors([parsed[i] for i in part]), lengths) >= THRESHOLD
            for i, flags in zip(part, np.split(p, np.cumsum(lengths)[:-1])):
                keep[i] = flags.tolist()
    return ["\n\n".join(b.text for b, k in zip(blocks, flags) if k) for blocks, flags in zip(parsed, keep)]


def main_text(page: Column, model: Model) -> Column:
    """The main text of a whole page."""

    def run(pages: pa.Array) -> pa.Array:
        return pa.array(main_texts(model, pages.to_pylist()), pa.string())

    return arrow_udf(run, "string")(page.cast("string"))
