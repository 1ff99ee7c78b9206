"""Main-text extraction by a recurrent labeller of a page's blocks.

A page is read into leaf blocks: runs of text between block-level tags, each with the path of
elements it stands in. A bidirectional LSTM (numpy, trained here on made-up labelled pages) reads
the whole sequence, each block as hashed path elements, hashed words and a few measures, and says
which blocks are the article's own text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scarmap.llm.html_pages import labelled_page

PATH_SLOTS, TAG_SLOTS, WORD_SLOTS, MEASURES = 512, 64, 64, 5
INPUTS = PATH_SLOTS + TAG_SLOTS + WORD_SLOTS + MEASURES
HIDDEN = 16
#: The training set, its seed and length; the model is the same in each run.
TRAINING_PAGES, EPOCHS, SEED = 700, 8, 11
#: Blocks labelled at a time, pages padded to the longest.
BLOCKS_AT_ONCE = 1 << 14

INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Elements that a tag of the same set ends, unless one of the enclosing kind is nearer.
SIBLINGS = {t: g for g in ({"li"}, {"dt", "dd"}, {"tr"}, {"td", "th"}, {"option", "optgroup"}) for t in g}
ENCLOSING = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}, "optgroup": {"select"}}

# Markup is read from each "<" on, by the states of the HTML standard: a quote delimits a value only
# right after "=", and nothing is tried twice (possessive repeats), so reading takes linear time.
_ATTRIBUTE = r"""[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]++|))?+"""
_TAG = re.compile(rf"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[\s/]++|{_ATTRIBUTE}|=)*+)>")
_COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?/][^>]*+(?:>|\Z)", re.S)
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+>", re.I) for t in ("script", "style")}
# Elements whose content isn't the page's own text. One that isn't closed inside the element that it
# stands in is an element like any other, so it takes nothing away.
SKIPPED = {"noscript", "template", "svg", "iframe", "object"}
#: Open elements beyond which the innermost one is left for the next.
MOST_DEPTH = 512
_NAMES = re.compile(r"""(?:^|[\s/"'])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_NAME_PARTS = re.compile(r"[a-z]+")


@lru_cache(1 << 16)
def _slot(token: str, slots: int) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % slots


class Element:
    """An open element: its tag, and the slots of its own path and names and of all around it, as
    the bits of a number, so that depth costs nothing. A skipped one knows what stood before it."""

    __slots__ = ("tag", "slots", "before")

    def __init__(self, tag: str, names: str, around: int, before: tuple | None = None) -> None:
        self.tag, self.slots, self.before = tag, around | 1 << _slot(tag, PATH_SLOTS), before
        for n in _NAME_PARTS.findall(names):
            self.slots |= 1 << _slot(f".{n}", PATH_SLOTS)


class Block:
    __slots__ = ("text", "slots", "tag", "linked")

    def __init__(self, text: str, slots: int, tag: str, linked: int) -> None:
        self.text, self.slots, self.tag, self.linked = text, slots, tag, linked


def blocks(html: str | None) -> list[Block]:
    """The blocks of a page that hold text, in page order; white space inside is one space.

    Unclosed and wrongly nested elements are read leniently; scripts, styles, comments and a tag
    cut off by the end of the page are skipped, as is what stands in closed elements of SKIPPED.
    """
    out: list[tuple[list[str], int, str, int]] = []  # parts of the text, slots, tag, linked characters
    stack: list[Element] = []  # block elements
    open_tags: Counter[str] = Counter()
    text: list[str] = []
    linked = in_link = 0

    def close_block() -> None:
        nonlocal text, linked
        if text:
            out.append((text, stack[-1].slots if stack else 0, stack[-1].tag if stack else "", linked))
            text = []
        linked = 0

    def add(s: str) -> None:
        nonlocal linked
        text.append(s)
        if in_link:
            linked += len(s)

    def cut(to: int) -> None:
        for e in stack[to:]:
            open_tags[e.tag] -= 1
        del stack[to:]

    def push(tag: str, attrs: str, before: tuple | None = None) -> None:
        if len(stack) >= MOST_DEPTH:
            cut(len(stack) - 1)
        names = " ".join(next(filter(None, n), "") for n in _NAMES.findall(attrs)).lower() if attrs else ""
        stack.append(Element(tag, names, stack[-1].slots if stack else 0, before))
        open_tags[tag] += 1

    at, html = 0, html or ""
    while (found := html.find("<", at)) >= 0:
        after = html[found + 1 : found + 3]
        if after[:1] in "!?" or after[:1] == "/" and not after[1:].isalpha():
            m = _COMMENT.match(html, found)
        elif after[:1].isascii() and after[:1].isalpha() or after[:1] == "/":
            m = _TAG.match(html, found)
        else:
            m = None if after else False
        if not after or m is None and not (after[0].isascii() and after[0].isalpha() or after[0] == "/"):
            add(html[at : found + 1])  # the character itself
            at = found + 1
            continue
        if found > at:
            add(html[at:found])
        at = m.end() if m else len(html)
        if m is None or m.re is _COMMENT:
            continue
        tag, ends = m["tag"].lower(), m["end"]
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            elif tag == "a":
                in_link = 0 if ends else 1
            continue
        if tag in _RAW and not ends:
            closed = _RAW[tag].search(html, at)
            at = closed.end() if closed else len(html)
            continue
        if tag in SKIPPED:
            if not ends and not m["attrs"].endswith("/"):
                before = len(out), text, linked, in_link
                close_block()
                text, in_link = [], 0
                push(tag, m["attrs"], before)
            elif ends and open_tags[tag]:
                i = next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag)
                size, text, linked, in_link = stack[i].before
                del out[size:]
                cut(i)
            continue
        close_block()
        in_link = 0
        if ends:
            if open_tags[tag]:
                cut(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag))
            continue
        if stack and stack[-1].tag == "p":
            cut(len(stack) - 1)
        if tag in SIBLINGS and any(open_tags[t] for t in SIBLINGS[tag]):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag in SIBLINGS[tag]:
                    cut(i)
                    break
                if stack[i].tag in ENCLOSING[tag]:
                    break
        elif tag == "body":
            cut(1 if stack and stack[0].tag == "html" else 0)
        if tag not in VOID:
            push(tag, m["attrs"])
    if at < len(html):
        add(html[at:])
    close_block()
    joined = ((" ".join(unescape("".join(parts)).split()), *rest) for parts, *rest in out)
    return [Block(t, *rest) for t, *rest in joined if t]


def features(found: list[Block], first: int = 0, total: int | None = None) -> np.ndarray:
    """The inputs of blocks, of which the page has ``total`` and ``first`` before these."""
    x = np.zeros((len(found), INPUTS), np.float32)
    words_at, total = PATH_SLOTS + TAG_SLOTS, total or len(found)
    octets = np.frombuffer(b"".join(b.slots.to_bytes(PATH_SLOTS // 8, "little") for b in found), np.uint8).reshape(len(found), -1)
    x[:, :PATH_SLOTS] = np.unpackbits(octets, axis=1, bitorder="little")
    for i, b in enumerate(found):
        x[i, PATH_SLOTS + _slot(b.tag, TAG_SLOTS)] = 1
        words = b.text.lower().split(" ")
        counts = np.bincount([_slot(w, WORD_SLOTS) for w in words], minlength=WORD_SLOTS)
        x[i, words_at : words_at + WORD_SLOTS] = np.sqrt(counts / len(words))
        x[i, -MEASURES:] = np.log1p(len(words)) / 4, np.log1p(len(b.text)) / 6, min(1.0, b.linked / len(b.text)), b.text[-1] in ".!?", (first + i) / total
    return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Labeller:
    """Two LSTMs, one for each direction, and a logistic output on their joined states."""

    def __init__(self, rng: np.random.Generator) -> None:
        h = HIDDEN
        self.p: dict[str, np.ndarray] = {"out": rng.normal(0, 0.3, (2 * h,)).astype(np.float32), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            wx = rng.normal(0, 0.1, (INPUTS, 4 * h))
            wx[: PATH_SLOTS] = 0  # an element never met says nothing
            self.p |= {f"x{d}": wx.astype(np.float32), f"h{d}": rng.normal(0, 0.2, (h, 4 * h)).astype(np.float32), f"b{d}": np.repeat([0.0, 1.0, 0.0, 0.0], h).astype(np.float32)}

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None, state: np.ndarray | None = None, cell: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """States (pages, blocks, hidden), and the last state and cell; a page's states pass
        unchanged over its padding. It begins with what came before, if that is given."""
        n, t, h = *mask.shape, HIDDEN
        z = x.reshape(n * t, -1) @ self.p[f"x{d}"] + self.p[f"b{d}"]
        z = z.reshape(n, t, 4 * h)
        out = np.zeros((n, t, h), np.float32)
        state = np.zeros((n, h), np.float32) if state is None else state
        cell = np.zeros((n, h), np.float32) if cell is None else cell
        for k in range(t) if d == "f" else range(t - 1, -1, -1):
            gates = z[:, k] + state @ self.p[f"h{d}"]
            sig, g = _sigmoid(gates[:, : 3 * h]), np.tanh(gates[:, 3 * h :])
            i, f, o = sig[:, :h], sig[:, h : 2 * h], sig[:, 2 * h :]
            m = mask[:, k, None]
            new = f * cell + i * g
            squashed = np.tanh(new)
            if keep is not None:
                keep.append((k, i, f, o, g, cell, squashed, state, m))
            cell, state = np.where(m, new, cell), np.where(m, o * squashed, state)
            out[:, k] = state
        return out, state, cell

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        states = np.concatenate([self._run(x, mask, "f", None)[0], self._run(x, mask, "b", None)[0]], axis=2)
        return states @ self.p["out"] + self.p["bias"]

    def long_scores(self, found: list[Block], at_once: int) -> np.ndarray:
        """The scores of one page, whose inputs are made ``at_once`` blocks at a time: each direction
        hands its state on from part to part."""
        n, h = len(found), HIDDEN
        out = np.full(n, self.p["bias"][0], np.float32)
        starts = list(range(0, n, at_once))
        for j, (d, order) in enumerate((("f", starts), ("b", starts[::-1]))):
            state = cell = None
            for lo in order:
                part = found[lo : lo + at_once]
                states, state, cell = self._run(features(part, lo, n)[None], np.ones((1, len(part)), bool), d, None, state, cell)
                out[lo : lo + len(part)] += states[0] @ self.p["out"][j * h : (j + 1) * h]
        return out

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        kept: dict[str, list] = {"f": [], "b": []}
        h, (n, t) = HIDDEN, mask.shape
        states = np.concatenate([self._run(x, mask, d, kept[d])[0] for d in "fb"], axis=2)
        off = (_sigmoid(states @ self.p["out"] + self.p["bias"]) - y) * mask / mask.sum()
        grads = {"out": np.einsum("nt,nth->h", off, states), "bias": np.array([off.sum()])}
        above = off[:, :, None] * self.p["out"]
        for j, d in enumerate("fb"):
            from_out = above[:, :, j * h : (j + 1) * h]
            dz = np.zeros((n, t, 4 * h), np.float32)
            dh, dc, gh = np.zeros((n, h)), np.zeros((n, h)), np.zeros_like(self.p[f"h{d}"])
            for k, i, f, o, g, cell, squashed, state, m in reversed(kept[d]):
                dh = dh + from_out[:, k]
                own_h, own_c = dh * m, dc * m
                total = own_c + own_h * o * (1 - squashed**2)
                step = np.concatenate([total * g * i * (1 - i), total * cell * f * (1 - f), own_h * squashed * o * (1 - o), total * i * (1 - g**2)], axis=1)
                dz[:, k] = step
                gh += state.T @ step
                dh, dc = step @ self.p[f"h{d}"].T + dh * ~m, total * f + dc * ~m
            flat = dz.reshape(n * t, -1)
            grads |= {f"x{d}": x.reshape(n * t, -1).T @ flat, f"h{d}": gh, f"b{d}": flat.sum(axis=0)}
        return grads


def _padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(len(s) for s in sequences)
    x = np.zeros((len(sequences), longest, INPUTS), np.float32)
    mask = np.zeros((len(sequences), longest), bool)
    for i, s in enumerate(sequences):
        x[i, : len(s)], mask[i, : len(s)] = s, True
    return x, mask


@lru_cache(1)
def trained() -> Labeller:
    """The labeller, trained by Adam on the made-up pages; once in a driver process."""
    rng = np.random.default_rng(SEED)
    data = []
    for seed in range(TRAINING_PAGES):
        html, labels = labelled_page(seed)
        found = blocks(html)
        assert len(found) == len(labels)
        data.append((features(found), np.array(labels, np.float32)))
    model = Labeller(rng)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    step = 0
    for _ in range(EPOCHS):
        order = sorted(rng.permutation(len(data)).tolist(), key=lambda i: len(data[i][1]) // 8)
        batches = [order[i : i + 32] for i in range(0, len(order), 32)]
        for b in rng.permutation(len(batches)):
            x, mask = _padded([data[i][0] for i in batches[b]])
            y = np.zeros(mask.shape, np.float32)
            for row, i in enumerate(batches[b]):
                y[row, : len(data[i][1])] = data[i][1]
            step += 1
            for k, g in model.gradients(x, mask, y).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                rate = 0.02 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                model.p[k] = (model.p[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-7)).astype(np.float32)
    return model


def extract(pages: list[str | None], model: Labeller, at_once: int = BLOCKS_AT_ONCE) -> list[str]:
    """The main text of each page."""
    found = [blocks(html) for html in pages]
    out = [""] * len(pages)
    for i, b in enumerate(found):
        if len(b) > at_once:
            out[i] = "\n".join(b.text for b, s in zip(b, model.long_scores(b, at_once), strict=True) if s > 0)
    order = sorted((i for i, b in enumerate(found) if 0 < len(b) <= at_once), key=lambda i: len(found[i]))
    while order:
        group = [order.pop()]
        longest = len(found[group[0]])
        while order and (len(group) + 1) * longest <= at_once:
            group.append(order.pop())
        x, mask = _padded([features(found[i]) for i in group])
        scores = model.scores(x, mask)
        for row, i in enumerate(group):
            out[i] = "\n".join(b.text for b, s in zip(found[i], scores[row], strict=False) if s > 0)
    return out


def main_texts(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages(page_id, url, html, …)``.

    A map over the rows: the model (under 1 MB) goes with the tasks. Null and empty pages, and
    pages without an article, have the empty text. Repeated rows and null ids and urls stay; an
    empty table gives no rows; other columns are ignored. A page is read whole, whatever its length
    and depth; the inputs of a long one are made part by part.
    """
    model = pages.sparkSession.sparkContext.broadcast(trained())

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for html in batches:
            rows = html.tolist()
            texts: list[str] = []
            lo = held = 0
            for hi, page in enumerate(rows, 1):  # so many pages at a time, or so much markup
                held += len(page or "")
                if hi - lo == 512 or held > 1 << 24 or hi == len(rows):
                    texts += extract(rows[lo:hi], model.value)
                    lo, held = hi, 0
            yield pd.Series(texts, dtype=object)

    out = pages.select("page_id", "url", extracted(pages["html"]).alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
