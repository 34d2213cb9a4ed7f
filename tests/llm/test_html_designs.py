"""HTML extraction on pages of designs it wasn't trained on, on deep and odd pages, and its vectors by brute force."""

import random
import time
import zlib

import numpy as np
import pytest

from pulse.llm import hashing
from pulse.llm import html_extract as X

VOCABULARY = random.Random(3).sample([a + b + c for a in ("ka", "lo", "mi", "ru", "te", "sho") for b in ("n", "r", "st", "mm") for c in ("a", "el", "ing", "or", "us", "y")], 120)


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) + rng.choice(["", "", "", "", ","]) for _ in range(n)).capitalize() + "."


def page(rng, open_article="<article>", close_article="</article>", inside="", after=""):
    """(html, the article's blocks)"""
    story = [prose(rng, 6)] + [prose(rng, rng.randrange(12, 60)) for _ in range(rng.randrange(2, 8))]
    items = "".join(f"<li><a href=/x>{rng.choice(VOCABULARY)}</a></li>" for _ in range(5))
    body = f"<h1>{story[0]}</h1>" + "".join(f"<p>{x}</p>" for x in story[1:])
    return (f"<html><body><nav><ul>{items}</ul></nav><div class=ad>{prose(rng, 8)}</div>{open_article}{body}{inside}{close_article}{after}"
            f"<footer>Imprint {prose(rng, 4)}</footer></body></html>", story)


@pytest.fixture(scope="module")
def weights():
    rng = random.Random(11)
    return X.fit([page(rng)[0] for _ in range(200)])


COMMENTS = "<p>Great read, thanks for this!</p><p>I do not agree with any of it, sorry.</p>"
DESIGNS = {
    "as trained": {}, "main": {"open_article": "<main>", "close_article": "</main>"},
    "plain div": {"open_article": "<div>", "close_article": "</div>"},
    "names of no meaning": {"open_article": "<div class='q7-kx zonk'>", "close_article": "</div>"},
    "comments after it": {"after": f"<section id='comments'>{COMMENTS}</section>"},
    "comments in it": {"inside": f"<section class='user-comments'>{COMMENTS}</section>"},
    "replies": {"after": "<ul class='thread replies'><li>Great read!</li><li>I do not agree.</li></ul>"},
    "choices": {"inside": "<select><option>first choice<option>second choice</select>"}}


@pytest.mark.parametrize("name", DESIGNS)
def test_pages_of_other_designs(weights, name):
    rng = random.Random(name)
    made = [page(rng, **DESIGNS[name]) for _ in range(60)]
    found = [X.blocks(h) for h, _ in made]
    right = total = 0
    for b, chosen, (_, story) in zip(found, X.label(weights, found, X.Vectors()), made):
        want = set(story)
        right += sum(bool(y) == (x.text in want) for x, y in zip(b, chosen))
        total += len(b)
    assert right >= 0.97 * total, (right, total)


def slow_row(block):
    """A block's vector, name by name and word by word."""
    path, seen = np.zeros(X.PATH_DIM), {}
    for x in block.path:
        bits = []
        for k in range(0, X.PATH_DIM, 32):
            c = zlib.crc32(x.encode(), 0x9E3779B9 + k)
            bits += [1.0 if c >> i & 1 else -1.0 for i in range(32)]
        path += np.array(bits) / 2 * 0.5 ** seen.get(x, 0)
        seen[x] = seen.get(x, 0) + 1
    words = np.zeros(X.WORD_DIM)
    for w in block.text.lower().split(" "):
        raw = np.frombuffer(w.encode(), np.uint8)
        h = int(hashing.word_hashes(raw, np.array([0, len(raw)]))[0][0])
        words += [1.0 if h >> k & 1 else -1.0 for k in range(X.WORD_DIM)]
    return np.concatenate([path, words / max(np.linalg.norm(words), 1) * np.sqrt(X.WORD_DIM) / 2])


def test_vectors_by_brute_force():
    """All names of a path and all words of a block count, and blocks share their element's sum."""
    deep = "<div class='a b'>" * 30 + "<section id=a><p>one two Three</p><p>" + " ".join(f"w{i}" for i in range(50)) + "</p>x</section>" + "</div>" * 12 + "<p>après ÄB</p>"
    b = X.blocks(deep)
    rows = X.Vectors().matrix(b)
    assert rows.shape == (4, X.SIZE)
    for x, row in zip(b, rows):
        assert row[:X.PATH_DIM + X.WORD_DIM] == pytest.approx(slow_row(x))
    inner = X.blocks(deep.replace("w25", "other"))
    assert not np.allclose(X.Vectors().matrix(inner)[1], rows[1])
    outer = X.blocks(deep.replace("<div class='a b'>", "<nav>", 1))
    assert not np.allclose(X.Vectors().matrix(outer)[0], rows[0])
    assert X.Vectors().path(X.place(b[0].path)) == pytest.approx(rows[0][:X.PATH_DIM])


@pytest.mark.parametrize("html", ["<div>t " * 20_000, "<p>t <b>u " * 10_000, "<div class='a b c d'>t</div>" * 10_000, "<p>" + "word " * 200_000])
def test_deep_and_long_pages(weights, html):
    """Texts at every level of a deep page: its paths are shared, not copied."""
    start = time.perf_counter()
    b = X.blocks(html)
    chosen = X.label(weights, [b], X.Vectors())[0]
    assert len(chosen) == len(b) and time.perf_counter() - start < 20


def test_extraction_of_awkward_rows(spark, weights):
    """Null, empty and long pages, repeated rows and ids, and columns named like the result or an inner one."""
    rng = random.Random(5)
    html, story = page(rng)
    long, long_story = page(rng, inside="".join(f"<p>{prose(rng, 20)}</p>" for _ in range(3_000)))
    rows = [(None, None, "a", "b"), (1, None, None, None), (2, "", "a", "b"), (3, " \n\t", "a", "b"), (4, html, "x", "y"), (4, html, "x", "y"), (4, long, "x", "y"), (5, "&lt;p&gt; 1 < 2", "x", "y")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string, _html string")
    out = X.extract(df.drop("text", "_html"), weights, ["page_id"]).collect()
    assert sum(r.text == "\n".join(story) for r in out if r.page_id == 4) == 2
    assert max(len(r.text) for r in out) > len("\n".join(long_story)) + 3_000 * 20
    assert all(r.text == "" for r in out if r.page_id in (None, 1, 2, 3))
    assert sorted(r.text for r in X.extract(df, weights, ["page_id"]).collect()) == sorted(r.text for r in out)
    again = [X.train(df), X.train(df.repartition(5))]
    assert all(np.array_equal(again[0][k], again[1][k]) for k in again[0])
