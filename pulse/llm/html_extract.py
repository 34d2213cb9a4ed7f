"""Main-text extraction with a recurrent block labeller.

A page is read as its leaf sequence: the text blocks in page order, each with
the path of open tags. A block's vector is the hashed tag path (all names,
classes, ids and roles) beside all its hashed words and a few counts. A bidirectional LSTM,
written in numpy, reads the whole sequence and says of every block whether it
belongs to the article, so a block is judged in the context of its document.

The model is trained on a bounded sample of the given pages. Their blocks are
labelled by their mark-up (inside an article or main element, and outside
menus, headers, footers, sidebars, notices, adverts, forms and comments), and
copies of the sample with tags renamed and boilerplate blocks put in teach it
other page designs.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm import hashing as H

TRAIN_PAGES = 300           # pages that are learned from, at most
TRAIN_BLOCKS = 120          # blocks in a row of a page that one training example holds
HIDDEN, STEPS, BATCH, RATE = 12, 500, 32, 0.02
PATH_DIM, WORD_DIM = 128, 16
# --- fixed values: HTML's raw-text, void, choice and block elements, and names that mark what isn't the article ---
RAW = {"script", "style", "textarea", "title", "iframe"}
FOREIGN = {"svg", "math"}
CHOICE = {"select", "datalist", "optgroup", "option"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "label", "legend", "li", "main", "menu", "nav",
         "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
CLOSES_P = BLOCK - {"body", "html", "button", "label", "legend", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
OUTSIDE = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog"}
MARKED = {"nav", "navbar", "menu", "header", "footer", "sidebar", "side", "ad", "ads", "advert", "advertisement", "banner", "promo", "sponsor", "sponsored",
          "cookie", "cookies", "consent", "notice", "popup", "modal", "newsletter", "subscribe", "share", "social", "comment", "comments", "related", "breadcrumb",
          "breadcrumbs", "widget", "login", "search", "pagination", "disqus", "reply", "replies"}
INSIDE = {"article", "main"}
# --------------------------------------------------------------------------------------------------------
GAP, BLANKS, KEY, BARE = re.compile(r"[\s/]*"), re.compile(r"\s*"), re.compile(r"=?[^\s/>=]*\s*"), re.compile(r"[^\s>]*")
NAME, AFTER_QUOTE = re.compile(r"[a-zA-Z][^\s/>]*"), re.compile(r"[\s/>]|\Z")
MARKS = {"class", "id", "role"}


@dataclass(eq=False)
class Place:
    """An open element: its names, how often each stands in the elements around it, and the element it is in.

    Blocks of one element share its place, so a path is never copied.
    """
    names: tuple[str, ...]      # the tag's name and its .names
    before: tuple[int, ...]
    parent: Place | None
    vector: np.ndarray | None = field(default=None, repr=False)


@dataclass
class Block:
    place: Place | None
    text: str
    linked: int                 # characters inside links

    @property
    def path(self) -> tuple[str, ...]:
        """Tag names and .names of the open elements, outermost first."""
        parts, at = [], self.place
        while at is not None:
            parts.append(at.names)
            at = at.parent
        return tuple(x for names in reversed(parts) for x in names)


def place(path: Iterable[str]) -> Place:
    """One place with the names of a whole path."""
    seen: Counter[str] = Counter()
    before = []
    path = tuple(path)
    for x in path:
        before.append(seen[x])
        seen[x] += 1
    return Place(path, tuple(before), None)


def _attributes(page: str, at: int, quotes: bool) -> tuple[list[str], int, bool]:
    """The class, id and role values of the tag whose attributes begin at ``at``, where
    the tag ends (-1: not before the page does), and whether a slash stands before that.

    A quoted value ends at its quote if a blank, a slash or the tag's end follows
    there; any other quote is a character like the rest, so it hides no text.
    """
    marks: list[str] = []
    while True:
        m = GAP.match(page, at)
        at = m.end()
        if at == len(page):
            return marks, -1, False
        if page[at] == ">":
            return marks, at + 1, m.group().endswith("/")
        key = KEY.match(page, at)
        at, value = key.end(), ""
        if page.startswith("=", at):
            at = BLANKS.match(page, at + 1).end()
            quote = page[at:at + 1]
            close = page.find(quote, at + 1) if quotes and quote in ("\"", "'") else -1
            if close >= 0 and AFTER_QUOTE.match(page, close + 1):
                value, at = page[at + 1:close], close + 1
            else:
                bare = BARE.match(page, at)
                value, at = bare.group(), bare.end()
        if key.group().strip().lower() in MARKS:
            marks.append(value)


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page: references decoded, white space as one space, trimmed, empty ones left out.

    Comments, declarations and the contents of raw-text elements are no text.
    A form's choices are blocks of their own; what svg, math, object, noscript
    and the like hold is text under their path. Unclosed elements end with their parent; a tag
    that the page's end cuts off is dropped. One pass over the page, whatever its tags and quotes.
    """
    out: list[Block] = []
    stack: list[tuple[str, Place]] = []
    opened: Counter[str] = Counter()        # names of the open elements: tags, and .names
    parts: list[str] = []
    linked, quotes = 0, True

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split(None)) if parts else ""
        if text:
            out.append(Block(stack[-1][1] if stack else None, text, linked))
        parts.clear()
        linked = 0

    def pop(name: str) -> None:
        while True:
            top, here = stack.pop()
            opened.subtract(here.names)
            if top == name:
                return

    page = page or ""
    at, last_end, last_open = 0, page.rfind(">"), page.rfind("<")
    while at < len(page):
        if page[at] != "<":
            end = page.find("<", at)
            piece = page[at:] if end < 0 else page[at:end]
            parts.append(piece)
            if opened["a"]:
                linked += len(piece.strip())
            at += len(piece)
            continue
        if page.startswith(("<!", "<?"), at):
            mark = "-->" if page.startswith("<!--", at) else ">"
            end = page.find(mark, at + 2)
            at = len(page) if end < 0 else end + len(mark)
            continue
        closing = page.startswith("/", at + 1)
        m = NAME.match(page, at + 1 + closing)
        if not m or (at > last_end and at < last_open):     # no tag, or one that never ends before another
            parts.append("<")
            linked += 1 if opened["a"] else 0
            at += 1
            continue
        if at > last_end:
            break
        name = m.group().lower()
        marks, end, slash = _attributes(page, m.end(), quotes)
        if end < 0:                     # its quotes hide every tag's end: from here on quotes are plain characters
            quotes = False
            marks, end, slash = _attributes(page, m.end(), quotes)
        at = end
        if closing:
            if name in BLOCK or name in CHOICE:
                flush()
            if opened[name]:
                pop(name)
            continue
        if name in BLOCK or name in CHOICE:
            flush()
        if name == "br":
            parts.append(" ")
        if name in VOID:
            continue
        if slash and (name in FOREIGN or any(opened[t] for t in FOREIGN)):
            continue
        if name in RAW:
            close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        if name in CLOSES_P and opened["p"]:
            pop("p")
        if name == "optgroup" and stack and stack[-1][0] == "option":
            pop("option")
        if name in ("li", "td", "th", "tr", "dt", "dd", "option", "optgroup") and stack and stack[-1][0] == name:
            pop(name)
        names = (name, *(f".{w}" for w in re.split(r"[^a-z0-9]+", " ".join(marks).lower()) if w)) if marks else (name,)
        stack.append((name, Place(names, tuple(opened[x] for x in names), stack[-1][1] if stack else None)))
        opened.update(names)
    flush()
    return out


def by_markup(block: Block) -> bool:
    """The training label: inside an article or main element and in nothing that marks other matter."""
    path = set(block.path)
    inside = any(x in INSIDE or x in (".article", ".main", ".content", ".post", ".entry") for x in path)
    return inside and not any(x in OUTSIDE or x in CHOICE or x.lstrip(".") in MARKED and x.startswith(".") for x in path)


SIGNS = np.array([[1.0 if x >> k & 1 else -1.0 for k in range(8)] for x in range(256)])


def _hashed(tokens: list[str], dim: int) -> np.ndarray:
    """A fixed row of -1 and 1 for each token: the bits of salted checksums, ``dim`` a multiple of 32 or 16."""
    raw = [x.encode("utf-8", "surrogatepass") for x in tokens]
    parts = []
    for k in range(0, dim, 32):
        c = np.fromiter((zlib.crc32(x, 0x9E3779B9 + k) for x in raw), np.uint32, len(raw))
        parts += [SIGNS[(c >> np.uint32(8 * i)) & np.uint32(255)] for i in range(4)]
    return np.concatenate(parts, axis=1)[:, :dim]


class Vectors:
    """Block vectors; the vectors of single names are kept while they are few."""

    def __init__(self) -> None:
        self.names: dict[str, np.ndarray] = {}

    def name(self, name: str) -> np.ndarray:
        v = self.names.get(name)
        if v is None:
            v = _hashed([name], PATH_DIM)[0] / 2
            if len(self.names) < 20_000:
                self.names[name] = v
        return v

    def path(self, at: Place | None) -> np.ndarray:
        """The sum over a path's names, each of which counts half as much every time it stands
        there again. A place's own names are added to its parent's sum, which it shares."""
        new = []
        while at is not None and at.vector is None:
            new.append(at)
            at = at.parent
        v = np.zeros(PATH_DIM) if at is None else at.vector
        for p in reversed(new):
            v = v.copy()
            for x, k in zip(p.names, p.before):
                v += self.name(x) * 0.5 ** min(k, 60)
            p.vector = v
        return v

    def matrix(self, found: list[Block]) -> np.ndarray:
        """One row per block: its path, its words, and counts."""
        raw, offsets = H.text_bytes(pa.array([b.text.lower() for b in found], pa.large_string()))
        hashes, _, _, first = H.word_hashes(raw, offsets)       # a block has a word at least
        n = np.diff(first)
        ones = np.stack([np.add.reduceat((hashes >> np.uint64(k)) & np.uint64(1), first[:-1]) for k in range(WORD_DIM)], axis=1)
        words = 2.0 * ones - n[:, None]
        words *= np.sqrt(WORD_DIM) / np.maximum(np.linalg.norm(words, axis=1), 1.0)[:, None]      # of one length, however often a word stands there
        extra = []
        for b, m in zip(found, n.tolist()):
            marks = b.text.count(".") + b.text.count(",") + b.text.count(";") + b.text.count("!") + b.text.count("?")
            extra.append((np.log1p(m) / 3, np.log1p(len(b.text)) / 5, b.linked / len(b.text), marks / m, 1.0))
        return np.concatenate([np.array([self.path(b.place) for b in found]), words / 2, np.array(extra)], axis=1)


SIZE = PATH_DIM + WORD_DIM + 5


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def start_weights(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = {}
    for d in ("f", "b"):
        w[d + "x"] = rng.normal(0, 1 / np.sqrt(SIZE), (SIZE, 4 * HIDDEN))
        w[d + "h"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        w[d + "0"] = np.concatenate([np.ones(HIDDEN), np.zeros(3 * HIDDEN)])       # forget gates start open
    w["out"] = rng.normal(0, 0.3, (2 * HIDDEN + SIZE, 1))
    return w


def _run(w: dict, d: str, x: np.ndarray, mask: np.ndarray, keep: bool):
    """One direction over (time, batch, SIZE); masked steps leave the state as it is."""
    t, n, _ = x.shape
    h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    hs, tape = np.zeros((t, n, HIDDEN)), []
    gx = x @ w[d + "x"] + w[d + "0"]
    for i in (range(t) if d == "f" else range(t - 1, -1, -1)):
        g = gx[i] + h @ w[d + "h"]
        f, a, o = (_sigmoid(g[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        u = np.tanh(g[:, 3 * HIDDEN:])
        m = mask[i][:, None]
        c2 = m * (f * c + a * u) + (1 - m) * c
        tc = np.tanh(c2)
        h2 = m * (o * tc) + (1 - m) * h
        if keep:
            tape.append((i, f, a, o, u, m, c, tc, h))
        h, c = h2, c2
        hs[i] = h
    return hs, tape


def logits(w: dict, x: np.ndarray, mask: np.ndarray, keep: bool = False):
    hf, tf = _run(w, "f", x, mask, keep)
    hb, tb = _run(w, "b", x, mask, keep)
    z = np.concatenate([hf, hb, x], axis=2)
    return (z @ w["out"])[:, :, 0], (z, tf, tb)


def _gradient(w: dict, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean logistic loss, back through time in both directions."""
    s, (z, tf, tb) = logits(w, x, mask, True)
    ds = (_sigmoid(s) - y) * mask / max(mask.sum(), 1)
    g = {"out": np.einsum("tnk,tn->k", z, ds)[:, None]}
    dz = ds[:, :, None] * w["out"][:, 0]
    for d, tape, dh_all in (("f", tf, dz[:, :, :HIDDEN]), ("b", tb, dz[:, :, HIDDEN:2 * HIDDEN])):
        dgx = np.zeros((*x.shape[:2], 4 * HIDDEN))
        dwh = np.zeros_like(w[d + "h"])
        dh, dc = np.zeros((x.shape[1], HIDDEN)), np.zeros((x.shape[1], HIDDEN))
        for i, f, a, o, u, m, c, tc, h in reversed(tape):
            dh = dh + dh_all[i]
            dc2 = dc + dh * m * o * (1 - tc ** 2)
            do, df, da, du = dh * m * tc, dc2 * m * c, dc2 * m * u, dc2 * m * a
            dg = np.concatenate([df * f * (1 - f), da * a * (1 - a), do * o * (1 - o), du * (1 - u ** 2)], axis=1)
            dgx[i] = dg
            dwh += h.T @ dg
            dh, dc = dg @ w[d + "h"].T + dh * (1 - m), dc2 * (m * f + (1 - m))
        g[d + "x"] = np.einsum("tnk,tnj->kj", x, dgx)
        g[d + "h"], g[d + "0"] = dwh, dgx.sum((0, 1))
    return g


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    t = max(len(p) for p in pages)
    x, mask = np.zeros((t, len(pages), SIZE)), np.zeros((t, len(pages)))
    for k, p in enumerate(pages):
        x[:len(p), k], mask[:len(p), k] = p, 1
    return x, mask


def _other_matter(base: tuple[str, ...], words: list[str], rng: np.random.Generator) -> list[tuple[Block, bool]]:
    """Blocks that aren't the article's, under ``base``: in an element that says so by its
    name, or by a name among others, or choices of a form."""
    kind = rng.integers(4)
    if kind == 0:
        tag = (sorted(OUTSIDE)[rng.integers(len(OUTSIDE))],)
    elif kind == 1 and rng.random() < 0.6:
        tag = ("select",)
    else:
        tag = (["div", "section", "ul", "ol"][rng.integers(4)], "." + sorted(MARKED)[rng.integers(len(MARKED))])
        if rng.random() < 0.5:
            tag = (tag[0], "." + words[rng.integers(len(words))].lower(), tag[1])
    out = []
    inner = "option" if tag[0] == "select" else "li" if tag[0] in ("ul", "ol") else ["p", "li", "span", "a"][rng.integers(4)]
    at = place((*base, *tag, inner))
    for _ in range(int(rng.integers(1, 4))):
        text = " ".join(words[k] for k in rng.integers(0, len(words), int(rng.integers(1, 30))))
        out.append((Block(at, text, len(text) if inner == "a" else 0), False))
    return out


def _redesigned(sample: list[Block], rng: np.random.Generator) -> list[tuple[Block, bool]]:
    """The page in another design: its article under another element, and blocks of other matter put in."""
    out: list[tuple[Block, bool]] = []
    words = [w for b in sample for w in b.text.split(" ")[:6]] or ["x"]
    other = " ".join("." + words[k].lower() for k in rng.integers(0, len(words), 2))       # names of no meaning
    swap = {"article": ["article", "main", "div .content", "section .post", "div .article", "div", "div " + other, "section " + other][rng.integers(8)]}
    for b in sample:
        path = tuple(y for x in b.path for y in swap.get(x, x).split(" "))
        label = by_markup(b)
        out.append((Block(place(path), b.text, b.linked), label))
        if rng.random() < 0.4:
            base = path[:-1] if label and rng.random() < 0.7 else path[:2]
            out += _other_matter(base, words, rng)
    if rng.random() < 0.5:
        out += _other_matter(("html", "body"), words, rng)
    return out


def fit(pages: list[str], steps: int = STEPS, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights of the labeller. Pages without any block in an article element teach nothing."""
    rng = np.random.default_rng(seed)
    vectors, w = Vectors(), start_weights(seed)
    sample = [b for b in map(blocks, pages) if any(map(by_markup, b))]
    if not sample:
        return w
    examples = []
    for b in sample:
        for labelled in ([(x, by_markup(x)) for x in b], _redesigned(b, rng), _redesigned(b, rng)):
            start = int(rng.integers(0, max(1, len(labelled) - TRAIN_BLOCKS + 1)))
            part = labelled[start:start + TRAIN_BLOCKS]
            examples.append((vectors.matrix([x for x, _ in part]), np.array([float(y) for _, y in part])))
    m, v = ({k: np.zeros_like(a) for k, a in w.items()} for _ in range(2))
    for t in range(1, steps + 1):
        chosen = [examples[k] for k in rng.integers(0, len(examples), BATCH)]
        x, mask = _padded([e[0] for e in chosen])
        y = np.zeros(mask.shape)
        for k, e in enumerate(chosen):
            y[:len(e[1]), k] = e[1]
        g = _gradient(w, x, mask, y)
        norm = np.sqrt(sum((a ** 2).sum() for a in g.values()))
        for k in w:
            gk = g[k] * min(1.0, 1.0 / max(norm, 1e-9))
            m[k], v[k] = 0.9 * m[k] + 0.1 * gk, 0.999 * v[k] + 0.001 * gk ** 2
            w[k] = w[k] - RATE * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    return w


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", limit: int = TRAIN_PAGES) -> dict[str, np.ndarray]:
    """Weights from at most ``limit`` pages, the least by a hash of their id; ids are chosen on the narrow column."""
    ids = pages.select(F.col(id_col).alias("_id")).where(F.col("_id").isNotNull()).distinct().orderBy(F.xxhash64("_id"), "_id").limit(limit)
    rows = pages.join(F.broadcast(ids), pages[id_col] == ids["_id"]).select("_id", html_col).where(F.col(html_col).isNotNull())
    rows = rows.groupBy("_id").agg(F.min(html_col)).collect()       # limit rows at most; a repeated id's least page
    return fit([r[1] for r in sorted(rows, key=lambda r: str(r[0]))])


def label(w: dict, pages: list[list[Block]], vectors: Vectors) -> list[np.ndarray]:
    """Whether each block of each page belongs to its article; pages of like length run together."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    while order:
        n = max(1, min(64, 20_000 // len(pages[order[min(63, len(order) - 1)]])))
        group, order = order[:n], order[n:]
        rows = vectors.matrix([b for k in group for b in pages[k]])
        ends = np.cumsum([len(pages[k]) for k in group])
        x, mask = _padded(np.split(rows, ends[:-1]))
        s, _ = logits(w, x, mask)
        for j, k in enumerate(group):
            out[k] = s[:len(pages[k]), j] > 0
    return out


def extract(pages: DataFrame, w: dict, keep: list[str], html_col: str = "html") -> DataFrame:
    """The columns ``keep`` of every page and ``text``: the blocks labelled as the
    article's, joined by newlines.

    Null or empty pages, and pages without such a block, have an empty text.
    Equal pages have equal texts; no pages give no rows.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema) + ", text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors()
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                b = whole.slice(i, 256)
                found = [blocks(h) for h in b.column("_html").to_pylist()]
                chosen = label(w, found, vectors)
                texts = ["\n".join(x.text for x, y in zip(p, c) if y) for p, c in zip(found, chosen)]
                yield pa.record_batch([*[b.column(c) for c in keep], pa.array(texts, pa.string())], [*keep, "text"])

    return pages.select(*keep, F.col(html_col).alias("_html")).mapInArrow(run, schema)
