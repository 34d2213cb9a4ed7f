"""URL rules by host-suffix and path-prefix expressions, in Spark SQL.

A rule is a host, a path prefix and a verdict. Each URL is expanded into its
host suffixes times its path directories, no deeper than the deepest rule;
rules are filed under their host and the directory part of their path. The two
meet in an equi-join on 32 bits of a SHA-256 digest; a hit counts once the full
digests agree and the URL's path starts with the rule's whole path. The longest
rule wins. Work per URL does not depend on the number of rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import collapse_rows

SALTS = 16      # a popular host's rows meet its rules in this many groups
SHORT = 8       # hexadecimal digits of the digest that are joined on


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _directory(path: Column) -> Column:
    """The path up to and with its last ``/`` (empty if none)."""
    return F.regexp_extract(path, r"(?s)\A(.*/)?", 1)


def _digest(host: Column, directory: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), directory), 256)


def _suffixes(host: Column, labels: int) -> Column:
    """The host's last 1 .. ``labels`` labels, and the host itself if it has no more."""
    parts = F.split(host, r"\.", -1)
    n = F.least(F.size(parts), F.lit(labels))
    return F.transform(F.sequence(F.lit(1), n), lambda k: F.array_join(F.slice(parts, -k, k), "."))


def _directories(path: Column, depth: int) -> Column:
    """Empty, and the path up to each of its first ``depth`` slashes."""
    slashes = F.least(F.length(path) - F.length(F.translate(path, "/", "")), F.lit(depth))
    some = F.transform(F.sequence(F.lit(1), F.greatest(slashes, F.lit(1))),
                       lambda k: F.concat(F.call_function("substring_index", path, F.lit("/"), k), F.lit("/")))
    return F.when(slashes == 0, F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), some))


def judge_urls(df: DataFrame, id_cols: list[str], url_col: str, rules: DataFrame, default: str = "allow",
               salts: int = SALTS) -> DataFrame:
    """``id_cols``, host, path, ``rule`` and ``verdict`` for every row of ``df``.

    ``rules`` has host, path, verdict. A rule fits its host and all subdomains
    where the path starts with the rule's; the longest (host and path) wins,
    then the longer host, then ``block``. Without one: rule null, verdict
    ``default``. Null urls and urls without ``://`` have an empty host and path
    and match no host. Rows that are equal in ``id_cols``, host and path are
    judged once and written as often as they came; no rules judge all by
    default; no rows give no rows. Other columns are ignored.
    """
    labels = F.size(F.split("host", r"\.", -1))
    slashes = F.length("path") - F.length(F.translate("path", "/", ""))
    r = rules.select(F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where(F.col("host").isNotNull())
    widest, deepest = r.agg(F.max(labels), F.max(slashes)).first()
    r = r.select(F.col("path").alias("_rpath"), F.col("verdict").alias("_verdict"),
                 F.concat("host", "path").alias("_rule"), F.length("host").alias("_rhost"),
                 _digest(F.col("host"), _directory(F.col("path"))).alias("_full"))
    r = r.withColumn("_short", F.substring("_full", 1, SHORT)).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    ids = [F.col(c) for c in id_cols]
    rows = collapse_rows(df.select(*ids, url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path")),
                         [*id_cols, "host", "path"])
    keys = [*id_cols, "host", "path", "part", "copies"]
    salt = F.pmod(F.xxhash64(*id_cols, "path", "part"), F.lit(salts)).cast("int")
    pairs = rows.select(*keys, salt.alias("_salt"), F.explode_outer(_suffixes(F.col("host"), widest or 1)).alias("_suffix"))
    pairs = pairs.select(*keys, "_salt", "_suffix", F.explode_outer(_directories(F.col("path"), deepest or 0)).alias("_dir"))
    pairs = pairs.withColumn("_digest", _digest(F.col("_suffix"), F.col("_dir")))
    hits = pairs.join(r, (F.substring(pairs["_digest"], 1, SHORT) == r["_short"]) & (pairs["_salt"] == r["_salt"])
                      & (pairs["_digest"] == r["_full"]) & pairs["path"].startswith(r["_rpath"]), "left")
    rank = F.when(F.col("_rule").isNotNull(), F.struct(F.length("_rule").alias("n"), F.col("_rhost").alias("h"),
                                                       (F.col("_verdict") == "block").cast("int").alias("b"),
                                                       F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict")))
    best = hits.groupBy(*keys).agg(F.max(rank).alias("_best"))
    out = best.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select(*id_cols, "host", "path", F.col("_best.rule").alias("rule"),
                      F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"))
