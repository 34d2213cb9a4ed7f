"""The corpus pipeline against brute force on a small corpus with planted cases."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pulse.llm.common import stash

from .test_operators import WORD, base, jaccard_components, jump, words


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(20)
    bench = [(i, " ".join(words(25, rng, 10**6))) for i in range(3)]
    docs, kinds = [], {}

    def add(kind, text):
        i = len(docs)
        docs.append((i, text, "en", f"s{i % 3}" if i % 11 else None, len(text or "")))
        kinds[i] = kind

    common = " ".join(words(8, rng, 10**6))
    for i in range(120):
        w = words(rng.randrange(60, 140), rng, 10**6)
        add("clean", " ".join(w[:30]) + "\n" + (common + "\n" if i % 2 else "") + " ".join(w[30:]))
    for g in range(5):
        w = words(120, rng, 10**6)
        for c in range(6):
            v = list(w)
            if c:
                v[rng.randrange(120)] = f"e{c}x{g}"
            add("copy", " ".join(v))
    for i in range(6):
        add("leak", " ".join(words(40, rng, 10**6)) + " " + bench[i % 3][1] + " " + " ".join(words(40, rng, 10**6)))
    add("junk", "a b c " * 40)
    add("junk", None)
    add("junk", "few words")
    d = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), docs, kinds, common


def test_stages_by_brute_force(spark, corpus):
    sf, docs, kinds, common = corpus
    first = spark.read.parquet(f"{sf}/documents.parquet")
    out = {}
    now = first
    for name, stage in corpus_pipeline.STAGES:
        now = stash(stage(spark, now, sf))
        out[name] = now.collect()
        if name != "sharding":
            assert now.columns == first.columns
    texts = {d: t for d, t, *_ in docs}

    # 6: what fails a base rule goes; the common line goes from every text of a host that has it more than ten times
    quality = {r.doc_id: r.text for r in out["quality_rules"]}
    assert set(quality) == {d for d, t in texts.items() if not base(t)[-1]} == {d for d, k in kinds.items() if k != "junk"}
    hosts = Counter(h for d, t, _, h, _ in docs if t and common in t)
    for d, t, _, h, _ in docs:
        if d in quality:
            assert quality[d] == "\n".join(x for x in t.split("\n") if not (x == common and hosts[h] > 10))
    assert max(hosts.values()) > 10 and all(r.n_chars == len(r.text) for r in out["quality_rules"])

    # 4: the least id of each group
    least = {c for _, _, c in jaccard_components(sorted(quality.items()))}
    single = {r.doc_id for r in out["ngram_jaccard_join"]}
    assert single == least and sum(kinds[d] == "copy" for d in single) == 5

    # 5: the planted benchmark passages, and nothing else
    clean = {r.doc_id for r in out["decontamination"]}
    assert clean == {d for d in single if kinds[d] != "leak"}

    # 2: sources near their targets, documents at most three times
    sizes = {r.doc_id: (r.source, len(WORD.findall(r.text))) for r in out["decontamination"]}
    source = Counter()
    for s, n in sizes.values():
        source[s] += n
    names = sorted((s for s in source if s is not None)) + ([None] if None in source else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    fixed, total = {}, sum(source.values())
    while True:
        level = (total - sum(fixed.values())) / sum(weight[s] for s in names if s not in fixed)
        above = [s for s in names if s not in fixed and level * weight[s] > 3 * source[s]]
        if not above:
            break
        fixed |= {s: 3 * source[s] for s in above}
    taken, times = Counter(), Counter(r.doc_id for r in out["mixing"])
    for d, n in times.items():
        taken[sizes[d][0]] += n * sizes[d][1]
    assert max(times.values()) <= 3
    assert all(abs(taken[s] - fixed.get(s, level * weight[s])) <= 71 for s in names)

    # 1: the published function
    assert len(out["sharding"]) == len(out["mixing"])
    assert all(r["shard"] == jump(r.doc_id, corpus_pipeline.SHARDS) for r in out["sharding"])


def test_run_and_an_empty_corpus(spark, corpus, tmp_path):
    sf, *_ = corpus
    whole = corpus_pipeline.run(spark, sf)
    assert whole.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard"] and whole.count() > 100
    empty = str(tmp_path)
    spark.read.parquet(f"{sf}/documents.parquet").where(F.lit(False)).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
