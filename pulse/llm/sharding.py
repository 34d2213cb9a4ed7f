"""Sharding by jump consistent hashing (Lamping and Veach 2014), in Spark SQL.

The shard of a row is a function of its key and the number of shards alone: no
ring table, no shuffle, no state. Appending a shard moves a key only into the
new shard, and only the necessary fraction of keys. The published generator
(a 64-bit linear congruential step) is computed on two 32-bit halves, because
Spark's ANSI arithmetic rejects a product that wraps around.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm.common import collapse_rows, stash

# --- fixed values: the published multiplier, 2862933555777941757, in 32-bit halves ---
MUL_HIGH, MUL_LOW = 0x27BB2EE6, 0x87B0B0FD
# --------------------------------------------------------------------------------------
M32 = 0xFFFFFFFF
ROWS_PER_RUN = 100_000      # rows numbered by one task at a time


def _lit(n: int) -> Column:
    return F.lit(n).cast("long")


def _mul32(a: Column, m: int) -> tuple[Column, Column]:
    """High and low 32 bits of ``a * m`` for 32-bit unsigned ``a``, without overflow."""
    low = a.bitwiseAND(_lit(0xFFFF)) * m
    high = F.shiftright(a, 16) * m
    total = low + F.shiftleft(high.bitwiseAND(_lit(0xFFFF)), 16)
    return F.shiftright(total, 32) + F.shiftright(high, 16), total.bitwiseAND(_lit(M32))


def _step(state: Column, shards: int) -> Column:
    """One jump: the state is (bucket, next bucket, high and low half of the key)."""
    carry, low = _mul32(state["lo"], MUL_LOW)
    low = low + 1
    _, cross1 = _mul32(state["hi"], MUL_LOW)
    _, cross2 = _mul32(state["lo"], MUL_HIGH)
    high = (carry + cross1 + cross2 + F.shiftright(low, 32)).bitwiseAND(_lit(M32))
    low = low.bitwiseAND(_lit(M32))
    scale = F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double")
    ahead = F.floor((state["next"] + 1).cast("double") * scale).cast("long")
    moved = F.struct(state["next"].alias("at"), ahead.alias("next"), high.alias("hi"), low.alias("lo"))
    return F.when(state["next"] < shards, moved).otherwise(state)


def jump(key: Column, shards: int) -> Column:
    """``struct(at, next, ...)`` after the jumps: ``at`` is the shard of ``key``
    (a 64-bit integer; null counts as 0) among ``shards``. A key jumps at most
    ``shards`` times and ln(shards) times on average; keys that need more than
    48 jumps take the rest in a second pass that others skip."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    key = F.coalesce(key.cast("long"), _lit(0))
    start = F.struct(_lit(-1).alias("at"), _lit(0).alias("next"),
                     F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(_lit(M32)).alias("lo"))
    first = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, 48))), start, lambda s, _: _step(s, shards))
    if shards <= 48:
        return first
    return F.when(first["next"] >= shards, first).otherwise(
        F.aggregate(F.sequence(F.lit(49), F.lit(shards)), first, lambda s, _: _step(s, shards)))


def with_shard(df: DataFrame, key: str, shards: int, shard: str = "shard", grown: str | None = None) -> DataFrame:
    """``df`` with its shard (int) and, in ``grown``, the shard among one more.

    A narrow projection: no shuffle, any columns beside. Integers are keys as
    they are; other types are hashed first. Null keys share one shard; equal
    keys share theirs. An existing column of that name is replaced. No rows
    give no rows.
    """
    kind = dict(df.dtypes)[key]
    k = df[key].cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(df[key])
    j = "_jump_" + shard
    out = df.withColumn(j, jump(k, shards)).withColumn(shard, F.col(f"{j}.at").cast("int"))
    if grown:       # the jump that left the old range lands in the new shard, or beyond it
        out = out.withColumn(grown, F.when(F.col(f"{j}.next") == shards, shards).otherwise(F.col(shard)).cast("int"))
    return out.drop(j)


def number_slots(df: DataFrame, cols: list[str], shard: str = "shard", rows_per_run: int = ROWS_PER_RUN) -> DataFrame:
    """The columns ``cols`` and ``shard`` of every row, with ``slot``: 0, 1, ...
    without gaps within each shard.

    Rows are dealt into hashed runs of about ``rows_per_run``; a run is numbered
    by one task and starts where the counts of the runs before it end, so no
    task holds a shard. Equal rows are counted before the shuffle and written
    out again at the end. The numbering depends on the rows alone.
    """
    keys = [*dict.fromkeys([*cols, shard])]
    rows = stash(collapse_rows(df.select(*keys), keys))
    total = rows.agg(F.sum("copies")).first()[0] or 0
    runs = total // rows_per_run + 1
    label = F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.col("part").cast("string"))
    rows = rows.withColumn("_run", F.conv(F.substring(F.md5(label.cast("binary")), 1, 13), 16, 10).cast("long") % runs)
    counts = rows.groupBy(shard, "_run").agg(F.sum("copies").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(shard).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(F.col(shard).alias("_shard"), F.col("_run").alias("_r"), F.coalesce(before, _lit(0)).alias("_start"))
    placed = rows.join(starts, (rows[shard].eqNullSafe(starts["_shard"])) & (rows["_run"] == starts["_r"]))
    inside = F.sum("copies").over(Window.partitionBy(shard, "_run").orderBy(*keys, "part").rowsBetween(Window.unboundedPreceding, 0))
    first = F.col("_start") + inside - F.col("copies")
    slots = placed.withColumn("_first", first)
    return slots.select(*keys, F.explode(F.sequence("_first", F.col("_first") + F.col("copies") - 1)).alias("slot"))
