"""Registered queries of the training-data operators: each applies one operator
to its whole table and derives the digest columns of its contract."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm import (
    bpe,
    chat,
    decontaminate,
    html_extract,
    jaccard_join,
    line_dedup,
    mixing,
    periodic,
    phrases,
    quality,
    sharding,
    toxicity,
    url_filter,
)
from pulse.llm.common import table, word_count, words

SHARDS = 8


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 8, its slot there, and its shard of 9."""
    text = F.coalesce("text", F.lit(""))
    d = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                                                 F.crc32(text.cast("binary")).alias("text_crc32"))
    d = sharding.with_shard(d, "doc_id", SHARDS, grown="grown_shard")
    slots = sharding.number_slots(d, ["doc_id", "size", "text_crc32", "grown_shard"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long"), "grown_shard")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: what it takes of each, and its source's target."""
    out = mixing.mix(table(spark, sf_dir, "documents"), "doc_id", word_count(F.col("text")))
    return out.select("doc_id", "size", "source", "source_size", "target", "taken")


# --- fixed values: the contract's rules (host, path, verdict) ---
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
# ----------------------------------------------------------------


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), ["page_id"], "url", rules)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, with the item and the windows that agree."""
    out = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), plain=True)
    return out.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_windows", "item_windows", "reparameterised")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base features and the verdict on every document."""
    out = quality.quality_rules(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_words", "kept")


# --- fixed values: the contract's extra conversation ---
EXTRA_CHAT = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
# -------------------------------------------------------


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted text."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.union(spark.createDataFrame(EXTRA_CHAT, "conv_id long, turn long, role string, text string"))
    chats = chat.format_chats(chat.linear_tree(turns), unique=True)
    read = chats.select("tree", "formatted", chat.read_back(F.col("formatted")).alias("turns"),
                        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(whole, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shingle count and its component of near duplicates."""
    out = jaccard_join.similar_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", F.col("component").alias("component_id"))


TOXIC = 0.7


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the labels of two thirds of the ids."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    weights = toxicity.train(docs.where(~held_out), labels.where(~held_out))
    out = toxicity.score(docs, weights, ["doc_id"])
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages")
    out = html_extract.extract(pages, html_extract.train(pages), ["page_id", "url"])
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines that go because a line like them stands earlier."""
    out = line_dedup.duplicate_lines(table(spark, sf_dir, "documents"), min_words=1)
    return out.select("doc_id", "n_lines", "n_dropped", "dropped")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every language's first 2000 collocations."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def repeated_from(text: Column, doc_id: Column) -> Column:
    """The contract's input: the words of a tenth of the documents repeat with period p from word a on (other texts as they are)."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g, n, w = F.floor(h / 10), F.size(words(text)).cast("long"), words(text)
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    copies = F.flatten(F.array_repeat(F.slice(w, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int")))
    told = F.slice(F.concat(F.slice(w, F.lit(1), a.cast("int")), copies), F.lit(1), n.cast("int"))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(told, " ")).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs and what is left without their repeats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", repeated_from(F.col("text"), F.col("doc_id")).alias("text"))
    out = periodic.periodic_runs(docs, ["doc_id"])
    top = F.get(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("o"), r["start"], r["period"]))), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    out = out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length = -F.col("top.o")
    return out.select("doc_id", "n_runs", F.col("top.start").alias("start"), length.alias("length"), F.col("top.period").alias("period"),
                      F.floor(1000 * length / F.col("top.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


RANK_FILE = "byte_bpe_50k.tiktoken"


def op13_byte_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Every document's ids and the bytes they decode to."""
    vocabulary = bpe.Vocabulary.read(path or public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    ids = bpe.encode(table(spark, sf_dir, "documents"), vocabulary, ["doc_id"])
    both = bpe.decode(ids, vocabulary, ["doc_id", "ids"])
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("bytes", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_mixing, op3_url_filter, op4_jaccard_join,
                                 op5_decontamination, op6_quality_rules, op7_chat_format, op8_toxicity, op9_html_extract, op10_line_dedup,
                                 op11_phrases, op12_periodic_runs, op13_byte_bpe)}
