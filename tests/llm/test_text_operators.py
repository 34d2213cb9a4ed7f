"""Phrase mining, periodic runs and byte-level BPE against brute force, and on awkward rows."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import tiktoken
from pyspark.sql import functions as F

from pulse.llm import bpe, periodic, phrases, queries
from tests.llm.test_operators import awkward

BREAKS = re.compile(r"[.,;:!?\x0A-\x0D]")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- phrases ---------------------------------------------------------------------------

def mined(rows, top=2000, min_count=10, max_words=3, percent=50):
    """rows: (text, lang). Straight from the definition, over Python integers."""
    out = []
    by_lang = defaultdict(list)
    for text, lang in rows:
        by_lang["und" if lang is None else lang].append(text or "")
    for lang, texts in by_lang.items():
        f, n = Counter(), 0
        for text in texts:
            for piece in BREAKS.split(text.translate(LOWER)):
                w = re.findall(r"[^\x20\x09]+", piece)
                n += len(w)
                f.update(tuple(w[i:i + k]) for k in range(1, max_words + 1) for i in range(len(w) - k + 1))
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        rows, held = [], Counter()
        for q, b in candidates.items():
            for p in {q[i:i + k] for k in range(2, len(q)) for i in range(len(q) - k + 1)}:
                held[p] = max(held[p], b)
        for p, a in candidates.items():
            if 100 * held[p] >= percent * a:
                continue
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


def prose(rng, n, words, seps=(" ", " ", " ", "\t", "  ", ". ", ",", "\n")):
    return "".join(rng.choice(words) + rng.choice(seps) for _ in range(n))


@pytest.fixture(scope="module")
def prose_rows():
    rng = random.Random(5)
    common, rare = ["a", "B", "é", "to", "The"], [f"r{i}" for i in range(60)]
    rows = [(prose(rng, rng.randrange(0, 120), common * 6 + rare), rng.choice(["en", "fr", None, "und", ""])) for _ in range(90)]
    return rows + [("New York Times " * 12, "en"), ("x y z " * 9 + "x y z", "en"), ("x y", "en"), (None, "en"), ("", None)] + [("same text here, twice", "fr")] * 11


@pytest.mark.parametrize("options", [
    {}, {"sample": 0.0, "max_words": 2}, {"sample": 0.5, "sample_count": 9, "filter_bits": 5}, {"max_words": 4, "min_count": 6, "inside_percent": 30, "sample": 0.3}, {"top": 3}])
def test_phrases_by_brute_force(spark, prose_rows, options):
    df = spark.createDataFrame(prose_rows, "text string, lang string")
    got = sorted(tuple(r) for r in phrases.collocations(df, **options).collect())
    names = {"inside_percent": "percent"}
    want = mined(prose_rows, **{names.get(k, k): v for k, v in options.items() if k in ("top", "min_count", "max_words", "inside_percent")})
    assert got == want and len(want) >= 5


def test_border_failures_take_further_passes(spark, prose_rows):
    docs = spark.createDataFrame(prose_rows, "text string, lang string").select(F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("lang").alias("lang_key"))
    all_seen, one = phrases.frequent_phrases(docs, sample=1.0, sample_count=1)
    none_seen, three = phrases.frequent_phrases(docs, sample=0.0)
    assert (one, three) == (1, 3)           # everything proposed: closed at once; nothing: words, pairs and triples fail in turn
    assert sorted(map(tuple, all_seen.collect())) == sorted(map(tuple, none_seen.collect()))


def test_counts_are_summed_when_the_buffer_is_full(spark, prose_rows, monkeypatch):
    c = phrases._Counter()
    monkeypatch.setattr(phrases, "BUFFER", 4)
    seen = Counter()
    for part in ([1, 1, 2], [2, 3], [9, 8, 7, 6], [1]):
        a = np.array(part, np.uint64)
        c.add([a, a, np.ones(len(a), np.int64)])
        if (r := c.full()) is not None:
            seen.update(dict(zip(r[0].tolist(), r[-1].tolist())))
    r = c.sum()
    seen.update(dict(zip(r[0].tolist(), r[-1].tolist())))
    assert seen == Counter({1: 3, 2: 2, 3: 1, 9: 1, 8: 1, 7: 1, 6: 1})


def test_scores_of_large_counts_are_exact(spark):
    big = 10**12
    rows = [(5, 1, 0, 0, 3 * big + 1), (5, 2, 0, 0, 3 * big + 7), (0, 1, 2, 0, 3 * big - 5)]
    p = spark.createDataFrame(rows, "lang_key long, w0 long, w1 long, w2 long, n long")
    r = phrases.cut_scores(p).collect()
    a, l, r_ = 3 * big - 5, 3 * big + 1, 3 * big + 7
    assert [(x.lang_key, x.a, x.l, x.r, x.score) for x in r] == [(5, a, l, r_, 10**6 * a * a // (l * r_))]


def test_phrases_of_awkward_rows(spark):
    d = awkward(spark).withColumn("rank", F.lit(1)).withColumn("n", F.lit("clash")).withColumn("w0", F.lit(1))
    rows = [(r.text, r.lang) for r in d.collect()]
    assert sorted(map(tuple, phrases.collocations(d, min_count=2).collect())) == mined(rows, min_count=2)
    assert phrases.collocations(d.limit(0)).count() == 0
    assert phrases.collocations(d.select(F.lit(None).cast("string").alias("text")), lang_col=None).count() == 0


# --- periodic runs ---------------------------------------------------------------------

def runs_of(w, min_length=6, min_repeats=4):
    out = []
    for q in range(1, len(w) // min_repeats + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            part = w[i:j + q]
            if len(part) >= max(min_length, min_repeats * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((i, len(part), q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_by_brute_force():
    rng = random.Random(3)
    found = 0
    for k in range(1500):
        letters = "ab" if k % 3 else "abcdefghij"
        w = []
        while len(w) < rng.randrange(1, 90):
            unit = [rng.choice(letters) for _ in range(rng.randrange(1, 8))]
            w += (unit * rng.randrange(1, 9))[:rng.randrange(1, 50)]
        for options in ((6, 4), (1, 3), (20, 5)):
            want = runs_of(w, *options)
            assert periodic.find_runs(w, *options) == want, (w, options)
            found += len(want)
    assert found > 2000
    with pytest.raises(ValueError):
        periodic.find_runs(["a"], 2, 2)


def test_segments_hold_every_word_often_enough():
    rng = random.Random(4)
    for _ in range(300):
        w = [rng.choice("abcdefgh"[:rng.randrange(1, 9)]) for _ in range(rng.randrange(0, 80))]

        def split(lo, hi):
            counts = Counter(w[lo:hi])
            for i in range(lo, hi):
                if counts[w[i]] < 4:
                    return split(lo, i) + split(i + 1, hi)
            return [(lo, hi)] if hi - lo >= 6 else []

        assert periodic.segments(w) == split(0, len(w))


def test_long_texts_take_no_quadratic_time():
    rng = random.Random(6)
    assert periodic.find_runs(["a"] * 100_000) == [(0, 100_000, 1)]
    w = [rng.choice("abcdefgh") for _ in range(30_000)] + ["x", "y", "z"] * 5_000
    assert (30_000, 15_000, 3) in periodic.find_runs(w)
    # each split leaves the next word too rare at the start of the rest
    deep = [x for i in range(20_000) for x in (f"u{i}", f"u{i + 1}", f"u{i}", f"u{i}")]
    assert periodic.segments(deep) == []


def collapsed(w, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def op12_row(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = runs_of(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{a},{b},{c}\n" for a, b, c in runs), collapsed(w, runs))]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sha)


def test_op12_by_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcd" if i % 2 else ["a", "bb", "é"]) for _ in range(rng.randrange(0, 70)))) for i in range(300)]
    rows += [(None, None), (None, "a b"), (-5, None), (301, "x " * 40), (301, "x " * 40), (302, " \t\n  a b a b")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()]
    key = repr
    assert sorted(got, key=key) == sorted((op12_row(*r) for r in rows), key=key)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(300)) > 20


def test_runs_of_awkward_rows(spark):
    d = awkward(spark).withColumn("runs", F.lit("clash"))
    out = periodic.periodic_runs(d, ["doc_id", "lang", "runs"]).collect()
    assert len(out) == 10 and all(r.runs == [] for r in out)
    assert sorted(r.collapsed for r in out) == sorted(" ".join(WORD.findall(r.text or "")) for r in d.collect())
    assert periodic.periodic_runs(d.limit(0), ["doc_id"]).count() == 0


# --- byte-level BPE ----------------------------------------------------------------------

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.read(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def strange_texts():
    rng = random.Random(2)
    chars = "abcdefgh etaoin  \n\t'sllvereé漢字🙂‍  \x1c0123456789.,!?<|endoftext|>"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randrange(0, 60))) for _ in range(400)]
    return texts + ["", " ", "a" * 5000, "ab" * 3000, " " * 4000, "0" * 777, "漢" * 900, "\n" * 300 + "x", "<|endoftext|>", "it's we'll I'D",
                    "".join(rng.choice("abcdefghijklmnop") for _ in range(20_000))]


def test_ids_are_those_of_the_library(spark, vocabulary, reference):
    texts = strange_texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, text string")
    enc = bpe.encode(df, vocabulary, ["k"])
    dec = bpe.decode(enc, vocabulary, ["k", "ids"]).collect()
    for r in dec:
        assert r.ids == reference.encode_ordinary(texts[r.k])
        assert bytes(r.bytes).decode() == texts[r.k]


def test_merges_of_long_matches_take_no_quadratic_time(vocabulary, reference):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    assert np.frombuffer(bpe.Coder(vocabulary).encode(text), np.int32).tolist() == reference.encode_ordinary(text)


def test_a_lower_rank_may_come_up_during_a_merge(reference):
    """Ranks whose order no training gives: joining a and b opens a pair of a lower rank."""
    tokens = [bytes([i]) for i in range(256)] + [b"abc", b"xabc", b"ab", b"bb", b"aab", b"abab"]
    lines = b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(tokens))
    v = bpe.Vocabulary(lines, public_tokenizers.PATTERN)
    own = tiktoken.Encoding("odd", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    rng = random.Random(1)
    c = bpe.Coder(v)
    for _ in range(2000):
        text = "".join(rng.choice("aabbcx") for _ in range(rng.randrange(1, 40)))
        assert np.frombuffer(c.encode(text), np.int32).tolist() == own.encode_ordinary(text)


def test_bpe_of_awkward_rows(spark, vocabulary, monkeypatch):
    d = awkward(spark).withColumn("ids", F.lit("clash"))
    out = bpe.decode(bpe.encode(d, vocabulary, ["doc_id", "text", "ids"]), vocabulary, ["doc_id", "text", "ids"]).collect()
    assert len(out) == 10 and all(bytes(r.bytes).decode() == (r.text or "") for r in out)
    assert bpe.encode(d.limit(0), vocabulary, ["doc_id"]).count() == 0
    broken = spark.range(1).select(F.lit(b"ok \xff").cast("string").alias("text"))
    assert bytes(bpe.decode(bpe.encode(broken, vocabulary, []), vocabulary, []).first().bytes).decode() == "ok �"
    none = spark.range(1).select(F.lit(None).cast("array<int>").alias("ids"))
    assert bytes(bpe.decode(none, vocabulary, []).first().bytes) == b""
    monkeypatch.setattr(bpe, "MAX_FILE_BYTES", 10)
    with pytest.raises(ValueError):
        bpe.Vocabulary.read(PATH, public_tokenizers.PATTERN)
    with pytest.raises(ValueError):
        bpe.Coder(bpe.Vocabulary(b"QQ== 0", "."))


def test_ids_without_a_token_are_refused_and_a_full_memo_keeps_what_is_used(vocabulary, reference, monkeypatch):
    c = bpe.Coder(vocabulary)
    for wrong in ([5, -1], [len(c.sizes)]):
        with pytest.raises(KeyError):
            c.decode(np.array(wrong, np.int32))
    gap = bpe.Coder(bpe.Vocabulary(b"\n".join(base64.b64encode(bytes([i])) + b" " + str(2 * i).encode() for i in range(256)), "."))
    assert gap.decode(np.array([2 * 65, 2 * 66], np.int32))[0].tobytes() == b"AB"
    with pytest.raises(KeyError):
        gap.decode(np.array([3], np.int32))
    monkeypatch.setattr(bpe, "MEMO_PIECES", 3)
    monkeypatch.setattr(bpe, "DECODED", 7)
    for text in strange_texts():
        ids = np.frombuffer(c.encode(text), np.int32)
        assert ids.tolist() == reference.encode_ordinary(text)
        assert c.decode(ids)[0].tobytes() == text.encode() and len(c.memo) <= 3 and len(c.older) <= 3


def test_op13_digests(spark, tmp_path, reference):
    rows = [(i, t) for i, t in enumerate(strange_texts())] + [(None, None), (3, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, queries.op13_byte_bpe(spark, str(tmp_path)).collect()), key=repr) == sorted(want, key=repr)


def test_a_batch_is_let_go_before_the_next_one_is_read():
    held, tasks = [], []

    class Docs:
        def mapInArrow(self, run, schema):
            tasks.append(run)
            raise StopIteration

    def batches(size=4 << 20):
        for _ in range(3):
            before = pa.total_allocated_bytes()
            yield pa.record_batch([pc.fill_null(pa.array(["word " * (size // 500)] * 100 + [None]), ""), pa.array([0] * 101, pa.int64())], ["text", "lang_key"])
            held.append(pa.total_allocated_bytes() - before)

    with pytest.raises(StopIteration):
        phrases.count_pass(Docs(), 3, None, None)
    for _ in tasks[0](batches()):
        pass
    assert len(held) == 3 and max(held) < 1 << 20
