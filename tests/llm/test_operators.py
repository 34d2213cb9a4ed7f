"""The training-data operators against brute force on small tables, and on awkward rows."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulse.llm import chat, components, decontaminate, hashing, html_extract, jaccard_join, line_dedup, mixing, quality, sharding, toxicity, url_filter
from pulse.llm.common import word_count

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, rng, pool=400):
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def awkward(spark, schema=DOCS):
    """Nulls everywhere, empty and long texts, ties, repeated rows."""
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \t\n ", None, "a", 4), (4, "Ab ab\u00a0c", "en", "b", 7),
            (5, long, "en", "b", len(long)), (6, long, "en", "a", len(long)), (7, "one two", "en", "a", 7), (7, "one two", "en", "a", 7), (None, "one two", "en", "a", 7)]
    return spark.createDataFrame(rows, schema)


# --- sharding ------------------------------------------------------------------------

def jump(key, n):
    b, j = -1, 0
    key &= 2**64 - 1
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int(float(b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("n", [1, 2, 8, 9, 100])
def test_jump_is_the_published_function(spark, n):
    keys = [0, 1, 2, -1, 2**63 - 1, -(2**63), *range(1000, 1200)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    out = sharding.with_shard(df, "k", n, grown="g").collect()
    assert [(r.shard, r.g) for r in out] == [(jump(r.k, n), jump(r.k, n + 1)) for r in out]


def test_slots_have_no_gaps_and_runs_do_not_matter(spark):
    df = spark.createDataFrame([(i // 3 if i % 2 else None,) for i in range(900)], "k long")
    d = sharding.with_shard(df, "k", 4)
    for run in (7, 100_000):
        by = defaultdict(list)
        for r in sharding.number_slots(d, ["k"], rows_per_run=run).collect():
            by[r.shard].append(r.slot)
        assert sum(map(len, by.values())) == 900
        assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_shards_of_awkward_rows(spark):
    d = awkward(spark).withColumn("shard", F.lit("clash"))
    out = sharding.with_shard(d, "doc_id", 8)
    assert out.count() == 10 and all(0 <= r.shard < 8 for r in out.collect())
    assert sharding.number_slots(out, ["doc_id"]).count() == 10
    assert sharding.number_slots(out.limit(0), ["doc_id"]).count() == 0


# --- mixing --------------------------------------------------------------------------

def test_targets_fill_up(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, "d": 0, "e": 40}
    s = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r for r in mixing.water_fill(mixing.repeating_weights(s), 3.0).collect()}
    total, fixed = sum(sizes.values()), {}
    weights = {k: r.weight for k, r in got.items()}
    while True:     # by hand: share, cut, share the excess again
        free = {k for k in sizes if k not in fixed}
        level = (total - sum(fixed.values())) / sum(weights[k] for k in free)
        above = {k for k in free if level * weights[k] > 3 * sizes[k]}
        if not above:
            break
        fixed |= {k: 3.0 * sizes[k] for k in above}
    want = {**fixed, **{k: level * weights[k] for k in free}}
    assert {k: r.target for k, r in got.items()} == pytest.approx(want)
    assert [weights[k] for k in "abcde"] == [1, 2, 3, 1, 2]


def test_mix_meets_targets_whatever_the_slices(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(words(rng.randrange(1, 60), rng)), f"s{i % 5}" if i % 7 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("target", F.lit("clash"))
    results = []
    for n in (17, 50_000):
        out = mixing.mix(df, "doc_id", word_count(F.col("text")), rows_per_slice=n).collect()
        results.append(sorted((r.doc_id, r.taken) for r in out))
        taken, target = Counter(), {}
        for r in out:
            taken[r.source] += r.taken
            target[r.source] = r.target
            assert r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
        assert sum(target.values()) == pytest.approx(sum(r.size for r in out))
        assert all(abs(taken[s] - t) <= 31 for s, t in target.items())
    assert results[0] == results[1] and len(results[0]) == 600


def test_mix_of_awkward_rows(spark):
    df = awkward(spark)
    out = mixing.mix(df, "doc_id", word_count(F.col("text")))
    assert out.count() == 10
    assert set(mixing.mixed(df).columns) == set(df.columns)
    assert mixing.mixed(df).count() == out.agg(F.sum("times")).first()[0]
    assert mixing.mix(df.limit(0), "doc_id", word_count(F.col("text"))).count() == 0


def test_heavier_documents_come_first_more_often(spark):
    rows = [(i, "x y z " * 3, "s") for i in range(2000)] + [(9000, "a " * 9000, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    heavy = F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)
    out = mixing.mix(df, "doc_id", word_count(F.col("text")), quality=heavy, weights=lambda s: s.withColumn("weight", F.when(F.col("source") == "s", 1).otherwise(2)))
    picked = [r.doc_id % 2 for r in out.where("source = 's' and taken > 0").collect()]
    assert 0 < len(picked) < 2000 and picked.count(0) > 1.5 * picked.count(1)


# --- URL rules -----------------------------------------------------------------------

def test_url_rules_by_brute_force(spark):
    rng = random.Random(2)
    hosts = ["a.com", "b.a.com", "x.b.a.com", "com", "net", "q.net", "", "A.COM", "a.com.", "aa.com"]
    paths = ["", "/", "/en/", "/en/x", "/en", "/e", "/en/x/y/z", "//", "/en//"]
    rules = [("com", "/", "allow"), ("a.com", "/en/", "block"), ("b.a.com", "/en/x", "allow"), ("net", "", "block"), ("a.com", "/e", "block")]
    urls = [None, "", "no scheme", "http://", "x://y://z"] + [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?a=/en/', '#/x'])}" for _ in range(300)]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] + [(None, "http://a.com/en/", "z")] * 3, "page_id long, url string, rule string")
    r = spark.createDataFrame(rules, "host string, path string, verdict string")
    out = url_filter.judge_urls(df, ["page_id"], "url", r).collect()
    assert len(out) == len(urls) + 3
    for got in out:
        u = "http://a.com/en/" if got.page_id is None else urls[got.page_id]
        host = path = ""
        if u and "://" in u:
            m = re.match(r"([^/?#]*)([^?#]*)", u.split("://", 1)[1])
            host, path = m.group(1).translate(LOWER), m.group(2)
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[2:] if fits else (None, "allow")
        assert (got.host, got.path, got.rule, got.verdict) == (host, path, rule, verdict), u
    assert url_filter.judge_urls(df.limit(0), ["page_id"], "url", r).count() == 0
    assert {x.verdict for x in url_filter.judge_urls(df, ["page_id"], "url", r.limit(0)).collect()} == {"allow"}


# --- n-gram Jaccard join -------------------------------------------------------------

def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard_components(docs):
    sets = [shingles(t) for _, t in docs]
    up = list(range(len(docs)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            s = len(a & sets[j])
            if s and 100 * s >= 80 * (len(a) + len(sets[j]) - s):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(docs)), key=repr)


def near_copies(rng):
    """Groups of copies with 0 to 6 words changed, chains, a shared passage, and documents of their own."""
    docs, passage = [], words(40, rng, 10**6)
    for g in range(4):
        base = words(100 + 20 * g, rng, 10**6)
        for c in range(25):
            w = list(base)
            for _ in range(rng.randrange(7)):
                w[rng.randrange(len(w))] = f"e{rng.random()}"
            docs.append(" ".join(w if c % 5 else w[:len(w) - 5 * (c // 5)]))
    for _ in range(30):
        w = words(rng.randrange(50, 90), rng, 10**6)
        docs.append(" ".join(w[:20] + passage + w[20:]))
    docs += ["", " ", "a b", "A  B", "a b c d e", "a b c d e f", None, "a b"]
    return [(i, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("cell", [1_000_000, 60])
def test_jaccard_join_is_exact(spark, monkeypatch, cell):
    monkeypatch.setattr(jaccard_join, "CELL_ROWS", cell)        # small cells are split, as hot ones are at scale
    docs = near_copies(random.Random(3))
    rng = random.Random(4)
    docs = [(rng.randrange(10**6), t) for _, t in docs]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    out = jaccard_join.similar_documents(df)
    assert sorted(((r.doc_id, r.n_shingles, r.component) for r in out.collect()), key=repr) == jaccard_components(docs)


def test_jaccard_join_of_awkward_rows(spark):
    df = awkward(spark).withColumn("label", F.lit("clash"))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    out = jaccard_join.similar_documents(df)
    assert sorted(((r.doc_id, r.n_shingles, r.component) for r in out.collect()), key=repr) == jaccard_components(rows)
    kept = jaccard_join.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([None, 1, 2, 3, 4, 5, None], key=repr)
    assert jaccard_join.similar_documents(df.limit(0)).count() == 0


def test_copies_at_the_limit_meet_their_pivot(spark, monkeypatch):
    """Copies that only just link to their base, and not to each other, are compared with it, not pair by pair."""
    rng = random.Random(21)
    base = words(150, rng, 10**6)
    docs = [(0, " ".join(base))]
    for i in range(1, 61):
        w = list(base)
        first = rng.randrange(6, 40)
        for at in (first, first + rng.randrange(10, 40), first + rng.randrange(60, 100)):
            w[at] = f"e{rng.random()}"
        docs.append((i, " ".join(w)))
    compared = []
    compare = jaccard_join._compare

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return compare(pairs, *rest)

    monkeypatch.setattr(jaccard_join, "_compare", counted)
    out = jaccard_join.similar_documents(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.n_shingles, r.component) for r in out.collect()), key=repr) == jaccard_components(docs)
    assert sum(compared) <= 2 * len(docs)


def test_a_pivot_of_ones_own_component_is_passed_over(spark):
    rows = [(7, node, 10, pos, label) for node, pos, label in [(1, 0, 1), (2, 1, 1), (3, 3, 9), (4, 2, 9), (5, 4, 5)]]
    open_cells = spark.createDataFrame(rows, "token long, node long, n long, pos long, label long")
    got = {r.node: r.pivot.node for r in jaccard_join._other_pivots(open_cells).collect()}
    assert got == {1: 4, 2: 4, 3: 1, 4: 1, 5: 1}


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(300, 300), (-5, 39)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in up if any(x in e and e[0] != e[1] for e in edges)}


def test_components_extended_by_more_links(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(-60, 60), rng.randrange(-60, 60)) for _ in range(40)] + [(i, i + 1) for i in range(200, 220)]
    more = [(rng.randrange(-90, 90), rng.randrange(-90, 90)) for _ in range(30)] + [(205, 400), (400, 401), (500, 501), (600, 600), (210, -90)]

    def found(df):
        return {r.node: r.label for r in df.collect()}

    one, two = (spark.createDataFrame(x, "a long, b long") for x in (edges, more))
    whole = found(components.components(one.union(two)))
    assert found(components.extended(components.components(one), two)) == whole
    assert found(components.extended(components.components(one.limit(0)), one.union(two))) == whole
    assert found(components.extended(components.components(one), two.limit(0))) == found(components.components(one))


def test_word_hashes_part_like_the_pattern():
    import pyarrow as pa
    texts = ["Ab  ab\tc\n", None, "", "é\u00a0é x", "a" * 3000 + " b", " ", "ab"]
    raw, offsets = hashing.text_bytes(pa.array(texts))
    h, s, e, first = hashing.word_hashes(raw, offsets)
    want = [WORD.findall((t or "").translate(LOWER)) for t in texts]
    flat = [w for x in want for w in x]
    assert list(np.diff(first)) == [len(x) for x in want] and len(h) == len(flat)
    assert all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(i))


# --- decontamination -----------------------------------------------------------------

BENCH = [(1, "A shop sells 12 apples for 3 dollars to Mary, how much do the 12 apples cost Mary in total today"),
         (2, "the quick brown fox jumps over the lazy dog and then it runs home to sleep until morning"), (3, "too short item"), (4, None), (5, "")]


def test_leaks(spark):
    rng = random.Random(6)
    pad = lambda: " ".join(words(20, rng, 10**6))      # noqa: E731
    q = BENCH[0][1]
    docs = {10: q, 11: f"{pad()} {BENCH[1][1]} {pad()}", 12: pad() + ". " + q.replace("12", "57").replace("3 dollars", "9 euros").replace("Mary", "John") + " " + pad(),
            13: pad() + ". " + q.replace("12", "57", 1) + " " + pad(), 14: pad(), 15: None, 16: "", 17: " ".join(BENCH[1][1].split()[:9]) + " " + pad(),
            18: BENCH[1][1].upper().replace(" ", " , "), 19: "too short item", 20: "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17"}
    df = spark.createDataFrame([(k, t, "x") for k, t in docs.items()] + [(11, docs[11], "y")], "doc_id long, text string, item_id string")
    b = spark.createDataFrame(BENCH, "item_id long, text string")
    out = {(r.id, r.item): r.reparameterised for r in decontaminate.leaks(df, b).collect()}
    assert out == {(10, 1): False, (11, 2): False, (12, 1): True}       # 13: the 12s became different numbers; 18 has names all along
    assert {r.doc_id for r in decontaminate.clean_documents(df, b).collect()} == set(docs) - {10, 11, 12}
    assert decontaminate.leaks(df.limit(0), b).count() == 0 and decontaminate.leaks(df, b.limit(0)).count() == 0
    assert decontaminate.leaks(awkward(spark), b).count() == 0


def test_leaks_in_any_letter_case(spark):
    rng = random.Random(61)
    pad = lambda: " ".join(words(20, rng, 10**6))      # noqa: E731
    q, fox = BENCH[0][1], BENCH[1][1]
    docs = {10: q, 12: q.replace("12", "57").replace("Mary", "John"), 30: f"{pad()} {q.upper()} {pad()}", 31: fox.title(), 32: f"{pad()} {q.lower()}",
            33: fox.upper().replace(" ", " , "), 34: " ".join(fox.upper().split()[:12]) + " " + pad(), 35: pad()}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    b = spark.createDataFrame(BENCH[:2], "item_id long, text string")
    out = {(r.id, r.item): r.reparameterised for r in decontaminate.leaks(df, b, plain=True).collect()}
    assert out == {(10, 1): False, (12, 1): True, (30, 1): False, (31, 2): False, (32, 1): False, (33, 2): False}
    assert {r.doc_id for r in decontaminate.clean_documents(df, b, plain=True).collect()} == {34, 35}
    assert decontaminate.leaks(df.limit(0), b, plain=True).count() == 0 and decontaminate.leaks(df, b.limit(0), plain=True).count() == 0


def test_leaks_of_short_and_numeric_items(spark):
    rng = random.Random(62)
    pad = lambda: " ".join(words(20, rng, 10**6))      # noqa: E731
    sums = "12 + 7 - 3 * 5 / 2 + 11 - 9 * 4 + 1"
    b = spark.createDataFrame([(1, "What is 3 plus 4?"), (2, sums), (3, "Paris"), (4, "?!"), (5, None), (6, "Seven words are one fewer than eight")], "item_id long, text string")
    docs = {1: f"{pad()}. What is 3 plus 4? {pad()}", 2: f"{pad()} {sums} {pad()}", 3: "WHAT IS 3 PLUS 4", 4: "What is 3 plus 5?", 5: sums.replace("11", "12"),
            6: "In PARIS, today", 7: "?!", 8: None, 9: "parisian", 10: "seven words are one fewer than eight", 11: "words are one fewer than eight", 12: "What is 3"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    out = sorted((r.id, r.item, r.n_windows, r.item_windows) for r in decontaminate.leaks(df, b, plain=True).collect())
    assert out == [(1, 1, 1, 1), (2, 2, 2, 2), (3, 1, 1, 1), (6, 3, 1, 1), (10, 6, 1, 1)]


# --- quality rules -------------------------------------------------------------------

def base(text):
    t = text or ""
    w = WORD.findall(t)
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(tri)
    inside = {i + k for i, x in enumerate(tri) if often[x] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(inside), failed


def test_base_features_and_line_frequency(spark):
    rng = random.Random(7)
    lines = [" ".join(words(12, rng, 10**6)) for _ in range(6)]
    docs = []
    for i in range(150):
        own = [" ".join(words(rng.randrange(1, 30), rng, 9 if i % 10 == 0 else 10**6)) + rng.choice(["", " # *", "&|"]) for _ in range(rng.randrange(1, 9))]
        body = own + rng.sample(lines, rng.randrange(0, 6)) * (2 if i % 4 == 0 else 1)
        rng.shuffle(body)
        docs.append((i, "\n".join(body), f"h{i % 3}" if i % 5 else None))
    docs += [(2000 + i, docs[1][1], "h2") for i in range(40)]       # copies count once
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    norm = lambda x: " ".join(re.findall(WORD, x.lower()))      # noqa: E731
    texts = defaultdict(set)
    for _, t, h in docs:
        for x in t.split("\n"):
            if norm(x):
                texts[h, norm(x)].add(t)
    frequent = {k for k, v in texts.items() if len(v) > max(10, 0.3 * len({t for _, t, h in docs if h == k[0]}))}
    out = quality.quality_rules(df, share=0.3).collect()
    assert len(out) == len(docs)
    for r in out:
        want = base(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        lost = sum(len(norm(x).split(" ")) for x in r.text.split("\n") if (r.source, norm(x)) in frequent)
        assert r.removed_words == lost, (r.doc_id, lost)
        assert r.kept == (not want[-1] and 100 * (want[0] - lost) >= 50 * want[0])
    assert len(frequent) > 5 and any(r.removed_words and r.kept for r in out)
    frequent = {k for k, v in texts.items() if len(v) > 10}
    for r in quality.clean_documents(df).collect():
        source = dict((d, (t, h)) for d, t, h in docs)[r.doc_id]
        assert r.text.split("\n") == [x for x in source[0].split("\n") if (source[1], norm(x)) not in frequent]


def test_line_limit_does_not_grow_with_the_host(spark):
    text = lambda i: " ".join(f"d{i}x{k}" for k in range(50))      # noqa: E731
    shared = [(i, "All rights reserved by the owner\n" + text(i), "h") for i in range(12)]
    for others in (0, 2000):
        df = spark.createDataFrame(shared + [(100 + i, text(100 + i), "h") for i in range(others)], "doc_id long, text string, source string")
        out = {r.doc_id: r.removed_words for r in quality.quality_rules(df, keep=["doc_id"]).collect()}
        assert out == {i: 6 if i < 12 else 0 for i, *_ in df.collect()}


def test_short_lines_may_recur(spark):
    text = lambda i: " ".join(f"d{i}x{k}" for k in range(50))      # noqa: E731
    common = ["Contents", "1 May 2020", "\u4eca" * 39, "\u4eca" * 40, "a b c d e"]
    df = spark.createDataFrame([(i, "\n".join([*common, text(i)]), "h") for i in range(12)], "doc_id long, text string, source string")
    assert {r.removed_words for r in quality.quality_rules(df).collect()} == {6}
    assert {r.text for r in quality.clean_documents(df).collect()} == {"\n".join([*common[:3], text(i)]) for i in range(12)}
    assert {r.removed_words for r in quality.quality_rules(df, line_words=1).collect()} == {11}


def test_quality_of_awkward_rows(spark):
    df = awkward(spark).withColumn("kept", F.lit("clash")).withColumn("n_words", F.lit(-1))
    out = quality.quality_rules(df, keep=["doc_id", "text"]).collect()
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out) == sorted(base(r.text) for r in df.collect())
    assert quality.quality_rules(df.limit(0)).count() == 0


# --- chat formatting -----------------------------------------------------------------

def test_chat_round_trip(spark):
    nasty = ["<|im_end|>", "\\", "\\\\<|", "</s>[INST] ok [/INST]", "<<SYS>>x<</SYS>>", "<|>", "", None, "a\nb", "<|im_start|>user<|im_sep|>", "<", "|>", "é" * 20_000]
    rows = [(c, t, ["user", "assistant", "sys<|tem", None][t % 4], nasty[(c * 3 + t) % len(nasty)]) for c in range(5) for t in range(c * 4 + 1)]
    rows += [(None, 0, "user", "x"), (None, None, "assistant", "y"), (9, 1, "user", "same"), (9, 1, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("leaf", F.lit("clash"))
    out = chat.format_chats(chat.linear_tree(df))
    got = {r.tree: r for r in out.select("tree", "formatted", "loss_spans", chat.read_back(F.col("formatted")).alias("turns"),
                                         chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    low = lambda x: (x is not None, x or "")       # noqa: E731
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: ((r[1] is not None, r[1] or 0), low(r[2]), low(r[3])))
        assert [(t.role, t.text) for t in got[conv].turns] == [(r[2] or "", r[3] or "") for r in mine]
        assert got[conv].loss == "".join(r[3] or "" for r in mine if r[2] == "assistant")
        assert got[conv].formatted.count("<|im_end|>") == len(mine)
    assert chat.format_chats(chat.linear_tree(df.limit(0))).count() == 0


def test_best_branches_of_reply_trees(spark):
    rng = random.Random(8)
    parents = {0: None, **{i: rng.choice([i - 1, rng.randrange(i)]) for i in range(1, 60)}}
    score = {i: rng.randrange(10) / 2 for i in parents}
    rows = [("t", i, p, "user" if i % 2 else "assistant", f"m{i}", score[i]) for i, p in parents.items()] + [("u", 5, 99, "user", "orphan", None)]
    m = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    paths = {}
    for i in set(parents) - set(parents.values()):
        path, at = [], i
        while at is not None:
            path.append(at)
            at = parents[at]
        paths[i] = path[::-1]
    best = sorted(paths, key=lambda i: (-sum(score[k] for k in paths[i]), i))[:3]
    out = defaultdict(list)
    for r in chat.branches(m, 3).collect():
        out[r.tree, r.rank].append((r.depth, r.node))
    assert [[n for _, n in sorted(out["t", k + 1])] for k in range(3)] == [paths[i] for i in best]
    assert out["u", 1] == [(1, 5)]
    texts = {r.formatted for r in chat.format_chats(m, 1).where("tree = 't'").select("formatted").collect()}
    assert len(texts) == 1 and [x for x in re.findall(r"m\d+", texts.pop())] == [f"m{i}" for i in paths[best[0]]]


# --- toxicity ------------------------------------------------------------------------

def test_toxicity_learns_from_positives_and_unlabelled(spark):
    rng = random.Random(9)
    bad = ["idiot", "scumbag", "trashy", "Vermin"]
    docs, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        w = words(rng.randrange(20, 200), rng)
        if toxic:
            for _ in range(max(2, len(w) // 20)):
                w[rng.randrange(len(w))] = rng.choice(bad) + rng.choice(["", "s", "!", ","])
        docs.append((i, " ".join(w)))
        if i % 2 == 0 or toxic:
            labels.append((i, int(toxic)))
    d = spark.createDataFrame(docs + [(None, None), (5000, ""), (5000, "")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    train = F.col("doc_id") % 5 < 3
    weights = toxicity.train(d.where(train), spark.createDataFrame(labels, "doc_id long, toxic int").where(train))
    out = toxicity.score(d, weights, ["doc_id"]).collect()
    assert len(out) == 903 and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.doc_id is not None and r.doc_id < 900 and r.doc_id % 5 >= 3]
    right = sum((r.score >= 0.7) == (r.doc_id % 6 == 0) for r in held)
    assert right >= 0.98 * len(held)
    none = toxicity.train(d.limit(0), spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score(d, none, ["doc_id"]).collect()} == {0.5}


def test_risk_stays_non_negative_with_overlapping_classes():
    index, begin = np.tile(np.arange(4), 50), np.arange(0, 201, 4)
    w = toxicity.fit(index, np.ones(200), begin, np.arange(50) < 25, 0.3)
    assert np.isfinite(w).all()


# --- HTML extraction -----------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><nav><ul><li><a href="/x">menu one</a></li><li><a>two</a></li></ul></nav>
<div class="ad">Buy this now.</div><!-- <p>hidden</p> --><article><h1>Title &amp; more {n}</h1><p><b>Bold  text</b> and\n<i>more</i> words of page {n}.<br>next<p>Unclosed paragraph &lt;tag&gt; {n}
<ul><li>item a</li><li>item b</li></ul></article><footer>&copy; footer {n}</footer>"""


def test_blocks():
    b = html_extract.blocks(PAGE.replace("{n}", "5"))
    assert [x.text for x in b if html_extract.by_markup(x)] == ["Title & more 5", "Bold text and more words of page 5. next", "Unclosed paragraph <tag> 5", "item a", "item b"]
    assert [x.text for x in b if not html_extract.by_markup(x)] == ["menu one", "two", "Buy this now.", "\u00a9 footer 5"]
    for odd in (None, "", "plain", "<", "<p", "</p>", "<p>x<scr", "<script>x", "<!-- x", "a < b", "<p class=\"x", "<a><b></a>x</b>"):
        html_extract.blocks(odd)
    assert [x.text for x in html_extract.blocks("a < b <p>c&am<q")] == ["a < b", "c&am"]


@pytest.mark.parametrize("page, want", [
    ("<p class=it's>Hello", ["Hello"]), ("<a title=\"x>Link text", ["Link text"]), ("<p title='a > b'>one", ["one"]), ("<p title = \"a > b\" id=x>one", ["one"]),
    ("<p><a title=\"x>Link text</a> on<p class=\"y\">two", ["Link text on", "two"]), ("<p a=\"\">one<p =b>two<p / c>three", ["one", "two", "three"]),
    ("<p>1 < 2 </3 <p>x</p ><br/>y", ["1 < 2 </3", "x", "y"]), ("<p>a<b x=\"1>\" <p>c", ["ac"]), ("one <two and <three", ["one <two and"]),
    ("<p>one</p class=\"a>b\">two<!-- > -->three<!doctype x>", ["one", "twothree"])])
def test_quotes_hide_no_text_and_leak_no_markup(page, want):
    assert [x.text for x in html_extract.blocks(page)] == want


def test_marks_of_attributes():
    b = html_extract.blocks("<DIV Class='a b' id=c-d data-class=no ROLE = \"e\">x")
    assert b[0].path == ("div", ".a", ".b", ".c", ".d", ".e")


@pytest.mark.parametrize("page", ["<p>it's " + "<a b " * 40_000, "<a b='" * 40_000, "<a b=\"x>\" " * 40_000, "<" * 200_000, "<div>" * 40_000, "<p>" * 40_000 + "</i>" * 40_000, "<a '>" * 40_000])
def test_odd_pages_take_one_pass(page):
    start = time.perf_counter()
    html_extract.blocks(page)
    assert time.perf_counter() - start < 5


def test_elements_without_an_end_tag_cut_nothing():
    texts = lambda page: [x.text for x in html_extract.blocks(page)]      # noqa: E731
    assert texts("<p>one<datalist><option value=a><option value=b></datalist><p>two") == ["one", "two"]
    assert texts("<article><p>one <svg class=icon /> two</p><p>three <svg><path d='x'/></svg> four") == ["one two", "three four"]
    assert texts("<p>Let <math><mi>x</mi></math> be <object data=a>a drawing</object> <noscript>shown</noscript></p>") == ["Let x be a drawing shown"]
    chosen = html_extract.blocks("<p>pick<select><optgroup><option>a<option>b<optgroup><option>c</select>rest</p><p>end")
    assert [(x.text, x.path[-1]) for x in chosen] == [("pick", "p"), ("a", "option"), ("b", "option"), ("c", "option"), ("rest", "p"), ("end", "p")]
    assert sum(x == "option" for x in chosen[3].path) == 1
    assert texts("<p>a<script>no</script><style>no</style><title>no</title><iframe>no</iframe><textarea>no</textarea>b") == ["ab"]


def test_gradient_by_finite_differences():
    rng = np.random.default_rng(1)
    w = html_extract.start_weights(3)
    x, mask = rng.normal(size=(5, 3, html_extract.SIZE)), np.ones((5, 3))
    mask[3:, 1] = 0
    y = rng.integers(0, 2, (5, 3)).astype(float) * mask

    def loss():
        s, _ = html_extract.logits(w, x, mask)
        return ((np.log1p(np.exp(s)) - y * s) * mask).sum() / mask.sum()
    g = html_extract._gradient(w, x, mask, y)
    for name in w:
        at = tuple(rng.integers(0, d) for d in w[name].shape)
        w[name][at] += 1e-5
        up = loss()
        w[name][at] -= 2e-5
        down = loss()
        w[name][at] += 1e-5
        assert g[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_extraction(spark):
    pages = [(i, PAGE.replace("{n}", str(i)), "u") for i in range(60)] + [(100, None, "u"), (101, "", "u"), (102, "<nav>only menu</nav>", "u"), (None, PAGE, "u"), (None, PAGE, "u")]
    df = spark.createDataFrame(pages, "page_id long, html string, text string")
    w = html_extract.train(df)
    out = html_extract.extract(df, w, ["page_id"]).collect()
    assert len(out) == len(pages)
    for r in out:
        if r.page_id is not None and r.page_id < 60:
            assert r.text.split("\n") == [f"Title & more {r.page_id}", f"Bold text and more words of page {r.page_id}. next", f"Unclosed paragraph <tag> {r.page_id}", "item a", "item b"]
        elif r.page_id is not None:
            assert r.text == ""
    assert html_extract.extract(df.limit(0), html_extract.train(df.limit(0)), ["page_id"]).count() == 0


# --- line deduplication --------------------------------------------------------------

def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(10)
    for _ in range(300):
        a, b = ("".join(rng.choice("abé") for _ in range(rng.randrange(12))) for _ in range(2))
        assert line_dedup.edit_distance(a, b) == slow_distance(a, b)


def plain_lines(text):
    out = []
    for i, x in enumerate((text or "").split("\n")):
        out.append((i, " ".join(re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", x.translate(LOWER)))))
    return out


def test_similarity_with_its_quick_bounds():
    rng = random.Random(12)
    for _ in range(400):
        a = " ".join("".join(rng.choice("abcé") for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(1, 7)))
        b = list(a)
        for _ in range(rng.randrange(5)):
            b[rng.randrange(len(b))] = rng.choice(["", "x", "ab", " "])
        b = " ".join("".join(b).split())
        assert line_dedup.similar(a, b, 0.8) == (slow_distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9)


def edited(w, rng, edits):
    w = list(w)
    for _ in range(edits):
        i = rng.randrange(len(w))
        w[i:i + 1] = rng.choice([[f"z{rng.randrange(10**6)}"], [], [w[i], f"z{rng.randrange(10**6)}"]])
    return w


@pytest.mark.parametrize("small", [2, 8])
def test_line_dedup_by_brute_force(spark, monkeypatch, small):
    """Against the edit similarity alone: what goes has a linked line before it, and nearly all that should go does."""
    monkeypatch.setattr(line_dedup, "SMALL", small)     # larger buckets go through their most frequent line
    rng = random.Random(11)
    bases = [words(n, rng, 10**6) for n in (1, 2, 3, 4, 5, 6, 8, 9, 11, 12, 14, 15, 20, 24, 26, 29, 31, 45, 50, 58, 61, 80)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(0, 8)):
            w = rng.choice(bases)
            if rng.random() < 0.7:
                w = edited(w, rng, rng.choice([0, 1, 1, 1, 2, 3]) if len(w) > 4 else 0)
            else:
                w = words(8, rng, 10**6)
            lines.append(" ".join(w) + rng.choice(["", "!", " ."]))
        docs.append((i, "\n".join([*lines, "short line"])))
    distinct = sorted({x for _, t in docs for _, x in plain_lines(t) if x})
    up = list(range(len(distinct)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    links = 0
    for i, x in enumerate(distinct):
        for j, y in enumerate(distinct[:i]):
            n = max(len(x), len(y))
            if abs(len(x) - len(y)) <= 0.2 * n and slow_distance(x, y) <= 0.2 * n + 1e-9:
                up[find(i)] = find(j)
                links += 1
    assert links > 50
    seen, want = set(), defaultdict(list)
    for d, t in docs:
        for i, x in plain_lines(t):
            if x:
                g = find(distinct.index(x))
                if g in seen:
                    want[d].append(i)
                seen.add(g)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("digest", F.lit("clash"))
    found = line_dedup.duplicate_lines(df, min_words=1)
    got = {r.doc_id: (r.n_lines, r.dropped) for r in found.collect()}
    assert {d: n for d, (n, _) in got.items()} == {d: len(t.split("\n")) for d, t in docs}
    assert all(set(lines) <= set(want[d]) for d, (_, lines) in got.items())
    assert sum(len(lines) for _, lines in got.values()) >= 0.95 * sum(map(len, want.values()))
    cleaned = {r.doc_id: r.text for r in line_dedup.without_lines(df.drop("digest"), found).collect()}
    assert cleaned == {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in got[d][1]) for d, t in docs}


@pytest.mark.parametrize("n, edits", [(5, 1), (9, 1), (12, 1), (14, 2), (18, 2), (23, 3), (25, 3), (30, 3), (47, 4), (60, 5), (120, 8)])
def test_similar_lines_meet(n, edits):
    """Nine of ten lines with so many edits share a bucket with the line they came from, unlike other lines of their length."""
    import pyarrow as pa
    rng = random.Random(n)
    lines = [words(n, rng, 3000) for _ in range(200)]
    texts = [" ".join(w) for x in lines for w in (x, edited(x, rng, edits))]
    raw, offsets = hashing.text_bytes(pa.array(texts))
    starts, ends, _, _, hashes, first = line_dedup._line_rows(raw, offsets)
    _, buckets, begin = line_dedup._sketch(hashes, first, *line_dedup._byte_pairs(raw, starts, ends, np.diff(first) < line_dedup.FEW))
    held = [set(buckets[begin[i]:begin[i + 1]].tolist()) for i in range(len(texts))]
    assert sum(bool(held[i] & held[i + 1]) for i in range(0, len(texts), 2)) >= 180
    assert sum(bool(held[i] & held[(i + 2) % len(texts)]) for i in range(0, len(texts), 2)) <= 2


def test_line_lengths():
    import pyarrow as pa
    raw, offsets = hashing.text_bytes(pa.array(["Ab,  \u00e9t\u00e9!\n\n--\n\u4eca\u5929 x", None, ""]))
    starts, ends, _, _, _, first = line_dedup._line_rows(raw, offsets)
    assert line_dedup._lengths(raw, starts, ends, np.diff(first)).tolist() == [6, 0, 0, 4]


def test_short_lines_are_lines(spark, tmp_path):
    from pulse.llm.queries import QUERIES
    docs = [(1, "All rights reserved\nfirst\n\u4eca\u5929\u5929\u6c14\u5f88\u597d"), (2, "second\nall rights reserved.\n--\n"), (3, "\u4eca\u5929\u5929\u6c14\u5f88\u597d\n--\n\nFirst!\nthird")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_lines, r.dropped) for r in QUERIES["op10_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: (3, []), 2: (3, [1]), 3: (5, [0, 3])}         # lines without a word stay


def test_line_dedup_of_awkward_rows(spark):
    df = awkward(spark)
    out = line_dedup.duplicate_lines(df).collect()
    assert len(out) == 10
    assert {r.doc_id: r.n_dropped for r in out}[6] == 1 and {r.doc_id: r.n_dropped for r in out}[5] == 0
    assert line_dedup.duplicate_lines(df.limit(0)).count() == 0


def test_links_go_through_the_rounds_once(spark, monkeypatch):
    """Pairs met across components add to what the first links gave, which isn't worked out anew."""
    rounds = components.components
    seen = []

    def counted(links):
        seen.append(links.count())
        return rounds(links)

    monkeypatch.setattr(components, "components", counted)
    monkeypatch.setattr(line_dedup, "components", counted)
    rng = random.Random(22)
    docs = []
    for i in range(20):
        w = words(12, rng, 10**6)
        docs += [(3 * i + c, " ".join(w[:11] + [f"e{c}"])) for c in range(3)]
    got = {r.doc_id: r.dropped for r in line_dedup.duplicate_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {d: [0] if d % 3 else [] for d, _ in docs}
    assert seen[0] > 0 and sum(seen) < 2 * seen[0]


def test_blocks_of_lines_by_brute_force():
    rng = np.random.default_rng(5)
    sizes = [0, 1, 2, 3, 40, 700, 1500, 5]
    words = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in sizes]
    words[4][:20] = words[4][20:]           # repeated words count once
    blocks = 3
    count, sims, whole = line_dedup._blocks(np.concatenate(words), np.repeat(np.arange(len(sizes)), sizes), len(sizes), blocks)
    for i, w in enumerate(words):
        distinct = np.unique(w)
        block = (hashing.mix(distinct + np.uint64(blocks)) >> np.uint64(32)).astype(np.int64) % blocks
        parts = [distinct[block == k] for k in range(blocks)]
        for got, n, part in [*zip(sims[i], count[i], parts), (whole[i], len(distinct), distinct)]:
            want = sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in part) > len(part))
            assert (int(got), n) == (int.from_bytes(want.to_bytes(8, "little"), "big"), len(part))     # bytes in the order they lie in memory


def test_changed_words_need_no_edit_distance(monkeypatch):
    a = " ".join(f"word{i}" for i in range(60))
    b = a.replace("word7 ", "").replace("word20", "another one").replace("word41", "word 41 twice")
    distance = line_dedup.edit_distance(a, b)
    assert distance <= line_dedup._aligned(a.split(" "), b.split(" "), 99) <= 0.2 * len(a)
    monkeypatch.setattr(line_dedup, "edit_distance", None)
    assert line_dedup.similar(a, b, 0.8)


def test_nothing_reaches_the_driver_row_by_row(spark, monkeypatch):
    def refused(self):
        raise AssertionError("rows go through the driver's Python")

    monkeypatch.setattr(type(spark.range(0)), "toPandas", refused)
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (2, text + " more"), (3, "quite another text of some words"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.component) for r in jaccard_join.similar_documents(df).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 3), (4, 4)]
