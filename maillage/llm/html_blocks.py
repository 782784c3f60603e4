"""HTML extraction: a recurrent labeller of the leaf blocks of a page.

A page is cut into leaf blocks: the text between two block-level tags, with its path of open elements.
A bidirectional LSTM in numpy reads the blocks of a page in order, each as a vector of its tag path
(element names and the parts of class, id and role), a vector of its hashed words, and a few measures,
and gives every block a probability of being main text, from the whole page as context.

The tables carry no labels for blocks. The model is trained on pages made here: text blocks of a
bounded sample of the given pages are set anew into pages whose containers are drawn from the lists
below, so that each block's label is known. Names of containers seen in real pages are thus learned as
features; no rule on names decides about a block.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maillage.llm.text import batches, prefix_sums, sums_by_row, windows

SAMPLE_PAGES = 200  # pages whose text is used in training pages
MADE_PAGES = 900
PATH_BUCKETS, WORD_BUCKETS = 1024, 256
PATH_DIM, WORD_DIM, MEASURES, HIDDEN = 16, 4, 6, 16
EPOCHS, BATCH_PAGES, RATE = 8, 32, 0.01
GROUP = 256  # pages labelled together
SEED = 13

# Elements that do not end a block, and those without an end tag.
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Formulas are part of the sentence around them.
INLINE |= frozenset("math mi mn mo ms mtext mspace mrow mfrac msup msub msubsup mover munder munderover msqrt mroot mstyle semantics annotation".split())
# Elements whose content is never text of a page: to the end tag, or to the end of the page.
_RAW = "script style noscript template textarea title iframe".split()
# Controls and drawings: left out where they end before any block does, else their tags alone are.
_CONTROLS = "button select svg object".split()
INLINE |= frozenset(_CONTROLS)
# An open element that one of the same group ends.
_SIBLINGS = {n: g for g in (("p",), ("li",), ("dt", "dd"), ("tr",), ("td", "th"), ("option",)) for n in g}
# Block elements that end an open paragraph.
_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul figure".split())

# No part of a tag outside of quotes has a `<`, so an open tag that never ends is looked through once and not once per `<`.
_ATTRIBUTES = r"(?:\"[^\"]*\"|'[^']*'|[^<>\"'])*"
_BLOCKS = "|".join(sorted((_ENDS_P | {"body", "html", "li", "tr", "td", "th", "dd", "dt"}) - {"form"}))
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(_RAW)})\b{_ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<control>{'|'.join(_CONTROLS)})\b{_ATTRIBUTES}>(?:[^<]|<(?!(?P=control)\b|/?(?:{_BLOCKS})\b|/(?P=control)\s*>))*</(?P=control)\s*>"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>{_ATTRIBUTES})>"
    r"|<[!?][^<>]*>",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
_PARTS = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # features of all open elements
    linked: int  # characters inside links
    depth: int


def _features(tag: str, attributes: str) -> tuple[str, ...]:
    if not attributes:
        return (tag,)
    names = [part for m in _NAMES.finditer(attributes) for part in _PARTS.findall((m[1] or m[2] or m[3] or "").lower())]
    return (tag, *("." + n for n in names))


def leaf_blocks(page: str) -> list[Block]:
    """Blocks with text in page order. White space inside a block is one space; character references are decoded."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, in_link, at = 0, 0, 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, tuple(f for _, own in stack for f in own), linked, len(stack)))
            parts, linked = [], 0

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at : m.start()]
            if "&" in piece:
                piece = html.unescape(piece)
            parts.append(piece)
            if in_link:
                linked += len(piece)
        at = m.end()
        if m["tag"] is None:
            if m["raw"] or m["control"]:
                parts.append(" ")
            continue
        tag, is_end, attributes = m["tag"].lower(), m["end"], m["attributes"]
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if is_end else 1
            elif tag == "br":
                parts.append(" ")
            continue
        flush()
        in_link = 0 if tag in _ENDS_P or tag == "li" else in_link
        if is_end:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in VOID:
            continue
        if tag in _ENDS_P and stack and stack[-1][0] == "p":
            stack.pop()
        if tag in _SIBLINGS:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in _SIBLINGS[tag]:
                    del stack[k:]
                    break
                if stack[k][0] in ("ul", "ol", "dl", "table", "div", "article", "section", "body"):
                    break
        if not attributes.rstrip().endswith("/"):
            stack.append((tag, _features(tag, attributes)))
    if at < len(page):
        parts.append(html.unescape(page[at:]))
    flush()
    return out


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % PATH_BUCKETS


def measures(blocks: list[Block]) -> np.ndarray:
    """Length, share of linked characters, number of words, sentence end, depth, place in the page."""
    n = len(blocks)
    return np.array([
        (np.log1p(len(b.text)) / 5, b.linked / len(b.text), np.log1p(b.text.count(" ")) / 5, b.text[-1] in ".!?:;…", b.depth / 10, k / n) for k, b in enumerate(blocks)
    ], np.float32).reshape(n, MEASURES)


def word_buckets(texts: list[str]):
    """For runs of blocks: (first block, word buckets, offsets of each block's own)."""
    for run in batches(pa.array(texts, pa.string())):
        starts, ends = run.words()
        yield run.lo, (windows(prefix_sums(run.data), starts, ends) % np.uint64(WORD_BUCKETS)).astype(np.int64), run.rows_of(starts)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class BlockLabeller:
    """Parameters by name: path and word tables, one LSTM a direction (input, state and bias to four gates), output."""

    params: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> BlockLabeller:
        size = PATH_DIM + WORD_DIM + MEASURES
        p = {"path": rng.normal(0, 0.3, (PATH_BUCKETS, PATH_DIM)), "word": rng.normal(0, 0.1, (WORD_BUCKETS, WORD_DIM)), "out": rng.normal(0, 0.3, 2 * HIDDEN), "bias": np.zeros(1)}
        for d in "fb":
            p |= {f"{d}x": rng.normal(0, size**-0.5, (size, 4 * HIDDEN)), f"{d}h": rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN)), f"{d}b": np.repeat([0.0, 1, 0, 0], HIDDEN)}
        return cls({k: v.astype(np.float32) for k, v in p.items()})

    def _direction(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States (steps, pages, hidden) of one direction; padded steps hold the state."""
        p, (steps, n, _) = self.params, x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        into = x @ p[f"{d}x"] + p[f"{d}b"]
        out = np.empty((steps, n, HIDDEN), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = into[t] + h @ p[f"{d}h"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            new = f * c + i * g
            m = mask[t][:, None]
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, new))
            c = np.where(m, new, c)
            h = np.where(m, o * np.tanh(new), h)
            out[t] = h
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate((self._direction(x, mask, "f"), self._direction(x, mask, "b")), 2)
        return both @ self.params["out"] + self.params["bias"]

    def gradients(self, path: np.ndarray, word: np.ndarray, extra: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over the blocks of padded pages; path and word hold bucket counts."""
        p = self.params
        x = np.concatenate((path @ p["path"], word @ p["word"], extra), 2)
        kept: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self._direction(x, mask, d, kept[d]) for d in "fb"], 2)
        error = np.where(mask, _sigmoid(both @ p["out"] + p["bias"]) - y, 0).astype(np.float32) / mask.sum()
        grads = {"out": np.einsum("tn,tnh->h", error, both), "bias": error.sum().reshape(1)}
        dx = np.zeros_like(x)
        for k, d in enumerate("fb"):
            above = error[:, :, None] * p["out"][k * HIDDEN : (k + 1) * HIDDEN]
            dh_next, dc_next = np.zeros_like(above[0]), np.zeros_like(above[0])
            gx, gh, gb = np.zeros_like(p[f"{d}x"]), np.zeros_like(p[f"{d}h"]), np.zeros_like(p[f"{d}b"])
            for t, h, c, i, f, o, g, new in reversed(kept[d]):
                m = mask[t][:, None]
                dh = above[t] + dh_next
                squashed = np.tanh(new)
                dc = np.where(m, dc_next + dh * o * (1 - squashed**2), 0)
                dz = np.concatenate((dc * g * i * (1 - i), dc * c * f * (1 - f), np.where(m, dh * squashed * o * (1 - o), 0), dc * i * (1 - g**2)), 1)
                gx += x[t].T @ dz
                gh += h.T @ dz
                gb += dz.sum(0)
                dx[t] += dz @ p[f"{d}x"].T
                dh_next = dz @ p[f"{d}h"].T + np.where(m, 0, dh)
                dc_next = dc * f + np.where(m, 0, dc_next)
            grads |= {f"{d}x": gx, f"{d}h": gh, f"{d}b": gb}
        grads["path"] = np.einsum("tnp,tnd->pd", path, dx[:, :, :PATH_DIM])
        grads["word"] = np.einsum("tnp,tnd->pd", word, dx[:, :, PATH_DIM : PATH_DIM + WORD_DIM])
        return grads

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Probability of main text of every block of every page."""
        flat = [b for page in pages for b in page]
        if not flat:
            return [np.zeros(0)] * len(pages)
        paths: dict[tuple[str, ...], np.ndarray] = {}
        for b in flat:
            if b.path not in paths:
                paths[b.path] = self.params["path"][[_bucket(f) for f in b.path]].sum(0) if b.path else np.zeros(PATH_DIM, np.float32)
        words = np.zeros((len(flat), WORD_DIM), np.float32)
        for lo, bucket, rows in word_buckets([b.text for b in flat]):
            for k in range(WORD_DIM):
                words[lo : lo + len(rows) - 1, k] = sums_by_row(self.params["word"][bucket, k], rows) / np.maximum(np.diff(rows), 1)
        extra = np.concatenate([measures(page) for page in pages if page])
        x = np.concatenate((np.stack([paths[b.path] for b in flat]), words, extra), 1).astype(np.float32)
        sizes = np.array([len(page) for page in pages])
        first = np.concatenate(([0], np.cumsum(sizes)))
        out = np.zeros(len(flat))
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] > 0]
        for at in range(0, len(order), 32):  # pages of like length, padded to the longest
            some = order[at : at + 32]
            longest = sizes[some].max()
            place = first[some] + np.minimum(np.arange(longest)[:, None], sizes[some] - 1)
            mask = np.arange(longest)[:, None] < sizes[some]
            out[place[mask]] = _sigmoid(self.logits(x[place], mask))[mask]
        return [out[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]


# Containers of made training pages, as (element, class or id) with their kind.
_MAIN = [("article", ""), ("main", ""), ("div", "content"), ("div", "main-content"), ("div", "post"), ("div", "entry-content"), ("section", "article-body"), ("div", "story"), ("div", "text"), ("div", "post-body"), ("article", "post"), ("div", "page"), ("div", ""), ("section", "")]
_BOILER = [
    ("nav", ""), ("header", ""), ("footer", ""), ("aside", ""), ("form", ""),
    *((e, c) for e in ("div", "section", "ul") for c in (
        "nav", "menu", "navbar", "navigation", "breadcrumbs", "sidebar", "side", "footer", "header", "banner", "masthead", "ad", "ads", "advert", "advertisement", "sponsored", "promo",
        "cookie", "cookie-notice", "consent", "notice", "popup", "modal", "newsletter", "subscribe", "signup", "login", "search", "share", "social", "related", "recommended", "comments",
        "comment", "comment-list", "replies", "reply", "respond", "copyright", "legal", "widget", "pagination", "tags", "toolbar", "topbar", "alert",
    )),
]
_OUTER = [("div", "wrapper"), ("div", "container"), ("div", "site"), ("div", "row"), ("div", "")]


def _tag(kind: tuple[str, str], rng: np.random.Generator) -> str:
    return f'<{kind[0]} {"id" if rng.random() < 0.3 else "class"}="{kind[1]}">' if kind[1] else f"<{kind[0]}>"


def made_page(texts: list[str], rng: np.random.Generator) -> list[tuple[Block, int]]:
    """Blocks of a page put together from ``texts``, each with its label. A mark in the text carries the label."""
    out: list[str] = []

    def pick(longest: int) -> str:
        words = texts[rng.integers(len(texts))].split()
        at = rng.integers(max(1, len(words) - longest + 1))
        return html.escape(" ".join(words[at : at + longest])) or "x"

    def boiler(inner: bool) -> None:
        kind = _BOILER[rng.integers(len(_BOILER))] if not inner or rng.random() < 0.9 else ("aside", "")
        out.append(_tag(kind, rng))
        style = rng.random()
        if style < 0.4 or kind[0] == "ul":
            items = [f'<li><a href="/">\x01{pick(rng.integers(1, 4))}</a></li>' for _ in range(rng.integers(2, 9))]
            out.extend(items if kind[0] == "ul" else ["<ul>", *items, "</ul>"])
        elif style < 0.7:
            out.append("\x01" + pick(rng.integers(2, 40)))
        else:
            out.extend(f"<p>\x01{pick(rng.integers(2, 40))}</p>" for _ in range(rng.integers(1, 5)))
        out.append(f"</{kind[0]}>")

    def bare_menu() -> None:
        out.append("<div><ul>" + "".join(f'<li><a href="/">\x01{pick(rng.integers(1, 4))}</a></li>' for _ in range(rng.integers(3, 9))) + "</ul></div>")

    def main() -> None:
        kind = _MAIN[rng.integers(len(_MAIN))] if rng.random() < 0.85 else None
        if kind:
            out.append(_tag(kind, rng))
        if rng.random() < 0.8:
            head = f"<h1>\x02{pick(rng.integers(1, 10))}</h1>"
            out.append(f"<header>{head}</header>" if rng.random() < 0.1 else head)
        for _ in range(int(rng.integers(1, 14))):
            style = rng.random()
            if style < 0.72:
                out.append(f"<p>\x02{pick(int(rng.integers(1, 120)))}" + ("</p>" if rng.random() < 0.7 else ""))
            elif style < 0.8:
                out.append(f"<h2>\x02{pick(6)}</h2>")
            elif style < 0.88:
                out.append("<ul>" + "".join(f"<li>\x02{pick(rng.integers(1, 30))}</li>" for _ in range(rng.integers(1, 5))) + "</ul>")
            elif style < 0.92:
                out.append(f"<blockquote>\x02{pick(30)}</blockquote>")
            elif style < 0.95:
                out.append("<table><tr>" + "".join(f"<td>\x02{pick(4)}</td>" for _ in range(3)) + "</tr></table>")
            elif style < 0.97:
                out.append(f"<div>\x02{pick(40)}</div>")
            else:
                boiler(True)
        if kind:
            out.append(f"</{kind[0]}>")

    outer = [_OUTER[rng.integers(len(_OUTER))] for _ in range(rng.integers(0, 3))]
    out.append("<html><body>" + "".join(_tag(o, rng) for o in outer))
    for _ in range(rng.integers(0, 4)):
        boiler(False)
    if rng.random() < 0.2:
        bare_menu()
    main()
    for _ in range(rng.integers(0, 4)):
        boiler(False)
    made = []
    for b in leaf_blocks("".join(out)):
        label = int("\x02" in b.text)
        b.text = b.text.replace("\x01", "").replace("\x02", "").strip() or "x"
        made.append((b, label))
    return made


def train(texts: list[str], made_pages: int = MADE_PAGES, epochs: int = EPOCHS) -> BlockLabeller:
    """Adam on made pages. Without texts a few fixed words stand in, so that the model exists for an empty table."""
    rng = np.random.default_rng(SEED)
    texts = [t for t in texts if t.strip()] or ["lorem ipsum dolor sit amet consectetur"]
    pages = [p for p in (made_page(texts, rng) for _ in range(made_pages)) if p]
    model = BlockLabeller.fresh(rng)
    ready = []
    for page in pages:
        blocks = [b for b, _ in page]
        path = np.zeros((len(blocks), PATH_BUCKETS), np.float32)
        word = np.zeros((len(blocks), WORD_BUCKETS), np.float32)
        for k, b in enumerate(blocks):
            np.add.at(path[k], [_bucket(f) for f in b.path], 1)
        for lo, bucket, rows in word_buckets([b.text for b in blocks]):
            row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
            np.add.at(word, (lo + row, bucket), (1 / np.maximum(np.diff(rows), 1))[row])
        ready.append((path, word, measures(blocks), np.array([y for _, y in page], np.float32)))
    ready.sort(key=lambda r: len(r[3]))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.params.items()}
    step, starts = 0, np.arange(0, len(ready), BATCH_PAGES)
    for epoch in range(epochs):
        for at in rng.permutation(starts):
            some = ready[at : at + BATCH_PAGES]
            longest = max(len(r[3]) for r in some)
            pad = lambda k: np.stack([np.pad(r[k], [(0, longest - len(r[3]))] + [(0, 0)] * (r[k].ndim - 1)) for r in some], 1)  # noqa: B023, E731
            path, word, extra, y = (pad(k) for k in range(4))
            mask = np.arange(longest)[:, None] < np.array([len(r[3]) for r in some])
            step += 1
            rate = RATE * (1 - epoch / epochs)
            for k, g in model.gradients(path, word, extra, mask, y).items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g**2 - v)
                model.params[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return model


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> BlockLabeller:
    """Train on texts of the ``sample_pages`` pages with the smallest id hashes."""
    chosen = pages.select("page_id").where(F.col("page_id").isNotNull()).orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages)
    rows = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id").collect()
    rows.sort(key=lambda r: (r["page_id"], r["html"] or ""))
    return train([b.text for r in rows for b in leaf_blocks(r["html"] or "")])


def _extract(model: BlockLabeller):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, GROUP):
                some = part.slice(at, GROUP)
                pages = [leaf_blocks(h or "") for h in some.column("html").to_pylist()]
                scores = model.label(pages)
                main = [[b.text for b, p in zip(page, score, strict=True) if p >= 0.5] for page, score in zip(pages, scores, strict=True)]
                yield pa.RecordBatch.from_arrays([some.column("page_id"), some.column("url"), pa.array(main, pa.list_(pa.string()))], ["page_id", "url", "blocks"])

    return run


def extract_blocks(pages: DataFrame, model: BlockLabeller | None = None) -> DataFrame:
    """Per page: page_id, url and the main-text blocks in page order.

    A null or empty html has no blocks, as has a page of boilerplate alone. Repeated rows are extracted
    once each. Unclosed elements end with their container; a page that is no HTML is one block of text.
    Other columns are not read.
    """
    model = model or fit(pages)
    id_type = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(_extract(model), f"page_id {id_type}, url string, blocks array<string>")
