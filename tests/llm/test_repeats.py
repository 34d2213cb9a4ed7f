"""Repeated rows, ids and messages in the training-data operators, and parents that form a cycle."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulse.llm import chat, decontaminate, toxicity

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima"


def test_repeated_items_and_documents(spark):
    """An item listed three times matches like one listed once: short and long, word for word and with other numbers."""
    short, long = " ".join(WORDS.split()[:8]) + " 7 mike", WORDS + " november oscar 12 papa quebec romeo sierra tango"
    docs = [(1, f"x {short} y"), (2, f"x {long} y"), (3, f"x {long.replace('12', '99')} y"), (4, f"x {short.replace('7', '55')} y"), (5, "nothing here"), (2, f"x {long} y")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    once = spark.createDataFrame([(1, short), (2, long)], "item_id long, text string")
    for plain in (False, True):
        want = sorted(map(str, decontaminate.leaks(d, once, plain=plain).collect()))
        assert len(want) == 4
        repeated = spark.createDataFrame([(1, short), (2, long)] * 3, "item_id long, text string")
        assert sorted(map(str, decontaminate.leaks(d, repeated, plain=plain).collect())) == want


MESSAGES = "tree long, node long, parent long, role string, text string, score double"


def test_repeated_messages(spark):
    rows = [(1, 1, None, "user", "a", 1.0), (1, 2, 1, "assistant", "b", 1.0), (1, 3, 2, "user", "c", 1.0)]
    want = sorted(map(str, chat.format_chats(spark.createDataFrame(rows, MESSAGES)).collect()))
    other = (1, 2, 1, "assistant", "zzz", 1.0)          # not the least of its node
    got = chat.format_chats(spark.createDataFrame([*rows, *rows, other, rows[1]], MESSAGES))
    assert sorted(map(str, got.collect())) == want and len(want) == 1
    assert chat.branches(spark.createDataFrame([*rows, *rows], MESSAGES)).count() == 3


@pytest.mark.parametrize("ring", [1, 2, 5])
def test_cycles_are_noticed(spark, ring):
    rows = [(1, i, (i + 1) % ring, "user", "x", 1.0) for i in range(ring)] + [(2, 1, None, "user", "a", 1.0)]
    with pytest.raises(ValueError, match="cycle"):
        chat.branches(spark.createDataFrame(rows, MESSAGES))


def test_deep_chains_are_no_cycles(spark):
    rows = [(1, i, i - 1, "user", "x", 1.0) for i in range(70)]
    assert chat.branches(spark.createDataFrame(rows, MESSAGES)).agg(F.max("depth")).first()[0] == 70


def test_the_toxicity_sample_is_bounded_in_rows(spark, monkeypatch):
    seen = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda index, value, begin, positive, prior: seen.append(positive) or fit(index, value, begin, positive, prior))
    rows = [(1, f"vile words {i}") for i in range(300)] + [(1, "vile words same")] * 50 + [(i, f"kind words {i}") for i in range(2, 200)] + [(2, "kind words 2")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("positive", F.lit("clash")).withColumn("digest", F.lit(0))
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (None, 1)], "doc_id long, toxic int")
    a = toxicity.train(docs, labels, max_positive=20, max_unlabelled=60)
    assert seen and seen[0].sum() == 20 and (~seen[0]).sum() <= 60
    assert np.array_equal(a, toxicity.train(docs.repartition(3), labels, max_positive=20, max_unlabelled=60))
