"""Exact Jaccard join of documents in the metric space of shingle sets.

The distance 1 - J is a metric, and documents link at distance 0.2 or less.
Far apart in that space everything is at distance 1 from everything else, so
pivots chosen for the whole corpus would replicate every document into every
region. Two facts keep the regions local and the join exact:

* A linked pair shares one of its first ``n - ceil(0.8 n) + 1`` shingles in any
  fixed order (rare ones first), so each such shingle is a cell, and documents
  are replicated into the cells of theirs and no others.
* In a cell, the document with the fewest rarer shingles is the pivot. Each
  document goes to the region of its nearest pivot (the one it shares most cells
  with), and its exact distance to the pivot is computed. Distance to a shared
  pivot bounds the distance of a pair: ``d(x, y) >= |d(x, p) - d(y, p)|``.

Documents linked to one pivot are connected, so a region's members are never
paired among each other. Cells that hold members of several components recurse:
what is left meets the pivots of what is left, and after ``levels`` rounds the
remaining pairs of different components that pass the size, position, count and
triangle windows are compared exactly. No pair of linked documents is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm import hashing as H
from pulse.llm.common import WORD, discard, stash
from pulse.llm.components import components, extended

SHINGLE = 5
BUCKET_BITS = 18            # shingles are counted in 2**18 buckets, whatever the size of the corpus
CELL_ROWS = 1_000_000       # larger cells are split, each part with a pivot of its own
REGION_ROWS = 20_000        # documents that one group compares with its pivot
LEVELS = 2


def _sets(column: pa.Array, size: int):
    raw, offsets = H.text_bytes(column)
    words, _, _, first = H.word_hashes(raw, offsets)
    return H.distinct(*H.shingle_hashes(words, first, size))


def _node(s: np.ndarray) -> int:
    """The identity of a set: equal sets, and only they (but for 64-bit collisions), have equal ones."""
    return int((H.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) ^ np.uint64(len(s))).astype(np.int64))


def _slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def document_sets(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Per document: id, digest of the text, n (distinct shingles) and node (its set's identity; null if empty);
    and one row per task with the counts of its shingles by bucket (``buckets``, ``counts``, id null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for whole in batches:
            for b in _slices(whole):
                sets = list(_sets(b.column("text"), size))
                total += np.bincount((np.concatenate(sets) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=len(total))
                n, node = [len(s) for s in sets], [_node(s) if len(s) else None for s in sets]
                k = b.num_rows
                yield pa.record_batch([b.column("id"), b.column("digest"), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                                       pa.nulls(k, pa.list_(pa.int32())), pa.nulls(k, pa.list_(pa.int64())), pa.array([False] * k)], NAMES)
        some = np.flatnonzero(total)
        if len(some):
            yield pa.record_batch([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                                   pa.array([some.astype(np.int32)], pa.list_(pa.int32())), pa.array([total[some]], pa.list_(pa.int64())),
                                   pa.array([True])], NAMES)

    return docs.select("id", "digest", "text").mapInArrow(
        run, "id long, digest long, n long, node long, buckets array<int>, counts array<long>, tally boolean")


NAMES = ["id", "digest", "n", "node", "buckets", "counts", "tally"]


def cells(docs: DataFrame, order: np.ndarray, heavy: np.ndarray, size: int = SHINGLE) -> DataFrame:
    """(token, node, info): each document in the cells of its first shingles.

    ``order`` ranks the buckets, rare ones first; a token is a shingle's hash
    with its bucket's rank on top. ``heavy`` gives the parts of a bucket's cells.
    ``info`` packs what :func:`_unpacked` reads: whether the cell is split, the
    part, n and pos, so a row of this largest shuffle is three numbers.
    """
    low = np.uint64((1 << (64 - BUCKET_BITS)) - 1)
    shift = np.uint64(64 - BUCKET_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for b in _slices(whole):
                parts: list[tuple] = []
                for s in _sets(b.column("text"), size):
                    if not len(s) or (node := _node(s)) in seen:
                        continue
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(node)
                    n = len(s)
                    k = n - (4 * n + 4) // 5 + 1
                    bucket = (s >> shift).astype(np.int64)
                    token = (order[bucket] << shift) | (s & low)
                    token = np.sort(np.partition(token, k - 1)[:k] if k < n else token)
                    parts.append((token, node, n))
                if parts:
                    lengths = [len(p[0]) for p in parts]
                    token = np.concatenate([p[0] for p in parts])
                    split = heavy[(token >> shift).astype(np.int64)]
                    node = np.repeat(np.array([p[1] for p in parts], np.int64), lengths)
                    part = (H.mix(node.view(np.uint64)) % split.astype(np.uint64)).astype(np.int64)
                    n = np.repeat(np.array([p[2] for p in parts], np.int64), lengths)
                    pos = np.concatenate([np.arange(x, dtype=np.int64) for x in lengths])
                    info = ((split > 1).astype(np.int64) << 62) | (part << 56) | (n << 28) | pos
                    yield pa.record_batch([pa.array(token.view(np.int64)), pa.array(node), pa.array(info)], ["token", "node", "info"])

    return docs.select("text").mapInArrow(run, "token long, node long, info long")


def _unpacked(rows: DataFrame) -> DataFrame:
    def bits(start: int, width: int):
        return F.shiftright("info", start).bitwiseAND(F.lit((1 << width) - 1).cast("long"))

    return rows.select("token", bits(56, 6).alias("part"), (bits(62, 1) == 1).alias("split"), "node", bits(28, 28).alias("n"), bits(0, 28).alias("pos"))


def _may_link(nx, ny, px, py):
    """Size and position windows: both hold at the first shared shingle of every linked pair."""
    need = 4 * (nx + ny)        # 9 * shared >= 4 * (nx + ny)
    return (5 * F.least(nx, ny) >= 4 * F.greatest(nx, ny)) & (9 * F.least(nx - px, ny - py) >= need)


FILTER_BITS = 25            # the filter's table has 2**25 bits (4 MB), whatever the size of the corpus


def _texts_of(docs: DataFrame, reps: DataFrame, placed: DataFrame) -> DataFrame:
    """``placed`` (node, _digest, _id and where the text goes) with the texts of its documents, all named in ``reps``.

    A bit table of the wanted digests, of fixed size, spares most other texts
    the shuffle while the wanted ones are few; the join decides. A text is sent
    once by its key, straight to the rows that place it.
    """
    at = F.pmod("_digest", F.lit(1 << FILTER_BITS))
    filled = reps.groupBy(F.shiftright(at, 5).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(31).cast("long")).cast("int"))).alias("bits"))
    filled = filled.toArrow()       # 2**20 rows at most, by column
    bits = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    bits[filled["word"].to_numpy()] = filled["bits"].to_numpy().astype(np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.column("digest").to_numpy() & ((1 << FILTER_BITS) - 1)
            yield b.filter(pa.array((bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1))

    some = docs.select("id", "digest", "text").mapInArrow(run, "id long, digest long, text string").withColumn("_key", F.xxhash64("digest", "id"))
    texts = some.repartition("_key").dropDuplicates(["_key", "digest", "id"])
    found = placed.withColumn("_key", F.xxhash64("_digest", "_id")).join(texts, "_key").where((F.col("digest") == F.col("_digest")) & F.col("id").eqNullSafe(F.col("_id")))
    return found.select("center", "group", "kind", "node", "text")


def _least_shared(nx, ny):
    """Of a linked pair's shared shingles, those that lie among the first ones of
    both: all but what can lie behind the end of either's first ones."""
    def behind(n):
        return F.floor((4 * n + 4) / 5) - 1

    return F.ceil(4 * (nx + ny) / 9) - F.greatest(behind(nx), behind(ny))


def _compare(pairs: DataFrame, docs: DataFrame, reps: DataFrame, size: int) -> DataFrame:
    """(center, node, shared, n_center, n_node): exact intersections of each node's set with its center's, stashed.

    ``pairs``, a stash, is deleted when they are written. Only the texts of these nodes are read. They travel to their center once; a center with many nodes is copied into
    several groups. Groups arrive sorted, center first, and are read as a stream.
    """
    counts = pairs.groupBy("center").agg(F.floor(F.count(F.lit(1)) / REGION_ROWS).cast("int").alias("last"))
    to = pairs.join(counts, "center").select("center", F.pmod(F.xxhash64("node"), F.col("last") + 1).cast("int").alias("group"), "node", F.lit(1).alias("kind"))
    own = counts.select("center", F.explode(F.sequence(F.lit(0), "last")).alias("group"), F.col("center").alias("node"), F.lit(0).alias("kind"))
    wanted = stash(reps.join(pairs.select("node").union(pairs.select("center")).distinct(), "node"))
    rows = _texts_of(docs, wanted, to.union(own).join(wanted, "node")).repartition("center", "group").sortWithinPartitions("center", "group", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, center = None, None
        for whole in batches:
            for b in _slices(whole):
                out: list[tuple] = []
                keys = zip(*(b.column(c).to_pylist() for c in ("center", "group", "kind", "node")))
                for (c, g, kind, node), s in zip(keys, _sets(b.column("text"), size)):
                    if kind == 0:
                        at, center = (c, g), s
                    elif at == (c, g):
                        where = np.minimum(np.searchsorted(center, s), len(center) - 1)
                        out.append((c, node, int((center[where] == s).sum()), len(center), len(s)))
                if out:
                    yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*out)], ["center", "node", "shared", "n_center", "n_node"])

    found = stash(rows.select("center", "group", "kind", "node", "text").mapInArrow(
        run, "center long, node long, shared long, n_center long, n_node long"))
    discard(wanted, pairs)
    return found


def similar_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, levels: int = LEVELS) -> DataFrame:
    """(id, digest, n_shingles, component, label): every row of ``df`` with the least id reachable by links.

    ``digest`` is the text's, ``label`` the component's own identity (null without shingles).

    Links: 100 * shared >= 80 * union of the sets of distinct ``size``-word
    shingles (A-Z lower-cased; the whole sequence if shorter). Texts that are
    null or without words have no shingles and link with nothing: each is its
    own component. Rows of equal sets are linked. Null ids are kept; a component
    of null ids only is null. No rows give no rows; other columns are ignored.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("digest", F.xxhash64("text"))
    features = stash(document_sets(docs, size))
    tally = features.where("tally").select(F.explode(F.arrays_zip("buckets", "counts")).alias("x"))
    counted = tally.groupBy("x.buckets").agg(F.sum("x.counts").alias("n")).toArrow()     # 2**18 rows at most, by column
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    counts[counted["buckets"].to_numpy()] = counted["n"].to_numpy()
    ranked = np.argsort(counts, kind="stable")
    order = np.empty(len(counts), np.uint64)
    order[ranked] = np.arange(len(counts), dtype=np.uint64)
    heavy = np.minimum(63, 1 + counts[ranked] // CELL_ROWS)      # by rank, as tokens carry it
    features = features.where("not tally")

    cell = Window.partitionBy("token", "part")
    rows = _unpacked(cells(docs, order, heavy, size).repartition("token", F.shiftright("info", 56).bitwiseAND(F.lit(63).cast("long"))))
    rows = rows.select("*", F.min(F.struct("pos", "n", "node")).over(cell).alias("pivot"), (F.min("node").over(cell) != F.max("node").over(cell)).alias("shared"))
    again = F.lag("node").over(cell.orderBy("node")) == F.col("node")      # an equal set from another task
    rows = rows.withColumn("again", F.coalesce(again, F.lit(False)))
    kept = stash(rows.where((F.col("shared") | F.col("split")) & ~F.col("again")).drop("shared", "again"))
    reps = stash(features.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(F.struct("digest", "id")).alias("rep"))
                 .select("node", F.col("rep.digest").alias("_digest"), F.col("rep.id").alias("_id")))

    labels, known = None, None
    entries = kept.select("token", "node", "n", "pos", F.col("node").alias("label"), "pivot")
    for level in range(levels):
        if level:
            entries = _other_pivots(_open_cells(kept, labels))
        px = F.col("pivot")
        met = entries.where(F.col("node") != px["node"]).withColumn("may", _may_link(F.col("n"), px["n"], F.col("pos"), px["pos"]))
        # The windows need hold at one cell only, the first shared one: all cells of the pivot count.
        met = met.groupBy("node", "n", px["node"].alias("center"), px["n"].alias("m")).agg(F.count(F.lit(1)).alias("cells"), F.max("may").alias("may")).where("may")
        # Only cells of this pivot are counted, so a quarter of what a link needs is asked for; the rest is met below.
        met = met.where(4 * F.col("cells") >= _least_shared(F.col("n"), F.col("m")))
        nearest = met.groupBy("node").agg(F.max(F.struct("cells", "center")).alias("m")).select("node", F.col("m.center").alias("center"))
        if known is not None:
            nearest = nearest.join(known.select("node", "center"), ["node", "center"], "left_anti")
        found = _compare(stash(nearest), docs, reps, size)
        labels = components(_linked(found)) if labels is None else extended(labels, _linked(found))
        if known is None:
            known = found
        else:
            before, known = known, stash(known.union(found))
            discard(before, found)

    # What is left: pairs of different components, compared exactly.
    left = _open_cells(kept, labels)
    distance = F.col("shared") / (F.col("n_center") + F.col("n_node") - F.col("shared"))
    near = known.groupBy("node").agg(F.max(F.struct(distance.alias("j"), "center")).alias("m"))
    left = left.join(near, "node", "left").select("token", "node", "n", "pos", "label", F.col("m.center").alias("p"), (1 - F.col("m.j")).alias("d"))
    # A linked pair's first shared cell has as many behind it, in either document, as the pair must still share.
    own = Window.partitionBy("node")
    left = stash(left.withColumn("cells", F.count(F.lit(1)).over(own) - F.row_number().over(own.orderBy("pos")) + 1))
    discard(kept, known)
    x = left.select(*[F.col(c).alias(c + "_x") for c in left.columns])
    y = left.select(*[F.col(c).alias(c + "_y") for c in left.columns])
    window = F.coalesce((F.col("p_x") != F.col("p_y")) | (F.abs(F.col("d_x") - F.col("d_y")) <= 0.2 + 1e-9), F.lit(True))
    pairs = x.join(y, (x["token_x"] == y["token_y"]) & (x["node_x"] < y["node_y"]) & (x["label_x"] != y["label_y"])
                   & _may_link(x["n_x"], y["n_y"], x["pos_x"], y["pos_y"]) & window
                   & (F.least("cells_x", "cells_y") >= _least_shared(F.col("n_x"), F.col("n_y"))))
    pairs = stash(pairs.select(F.col("node_x").alias("center"), F.col("n_x").alias("m"), F.col("node_y").alias("node"), F.col("n_y").alias("n")).distinct())
    # How many of their first shingles they share, against what a link needs: one row per pair, not one per shared cell.
    firsts = left.groupBy("node").agg(F.collect_list("token").alias("tokens"))
    both = pairs.join(firsts.select(F.col("node").alias("center"), F.col("tokens").alias("_c")), "center").join(firsts, "node")
    enough = both.where(F.size(F.array_intersect("_c", "tokens")) >= _least_shared(F.col("n"), F.col("m")))
    enough = stash(enough.select("center", "node"))
    discard(left, pairs)
    found = _compare(enough, docs, reps, size)
    labels = extended(labels, _linked(found))
    discard(found, reps)
    f = features.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = f.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("id").alias("component"))
    alone = f.where(F.col("label").isNull()).select("id", "digest", "n", F.col("id").alias("component"), "label")
    out = f.join(least, "label").select("id", "digest", "n", "component", "label").union(alone)
    return out.select(F.col("id").alias(id_col), "digest", F.col("n").alias("n_shingles"), "component", "label")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay: of each component the least by (id, digest of
    the text), null ids first; of equal rows one. Texts without words all stay."""
    found = similar_documents(df, id_col, text_col)
    some = found.where(F.col("label").isNotNull()).groupBy("label").agg(F.min(F.struct(F.col(id_col).alias("id"), "digest")).alias("s"))
    stays = some.select(F.col("s.id").alias("_id"), F.col("s.digest").alias("_digest"))
    d = df.withColumn("_key", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    first = F.row_number().over(Window.partitionBy("_key", id_col).orderBy("_key"))
    chosen = d.join(stays, (d["_key"] == stays["_digest"]) & d[id_col].eqNullSafe(stays["_id"]))
    chosen = chosen.withColumn("_nth", first).where(F.col("_nth") == 1)
    wordless = df.where(F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)) == 0)
    return chosen.select(*df.columns).union(wordless)


def _linked(found: DataFrame) -> DataFrame:
    """Links among compared pairs: 100 * shared >= 80 * union."""
    union = F.col("n_center") + F.col("n_node") - F.col("shared")
    return found.where(100 * F.col("shared") >= 80 * union).select(F.col("center").alias("a"), F.col("node").alias("b"))


def _open_cells(kept: DataFrame, labels: DataFrame) -> DataFrame:
    """The entries of cells that hold members of more than one component, with their component's label."""
    e = kept.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")).select("token", "node", "n", "pos", "label")
    several = e.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where(F.col("low") != F.col("high"))
    return e.join(several.select("token"), "token")


def _other_pivots(open_cells: DataFrame) -> DataFrame:
    """Each entry with the pivot of its cell, or, in the pivot's own component, with the first entry of another one."""
    first = F.min(F.struct("pos", "n", "node", "label"))
    e = open_cells.join(open_cells.groupBy("token").agg(first.alias("pivot")), "token")
    others = e.where(F.col("label") != F.col("pivot.label")).groupBy("token").agg(first.alias("other"))
    pivot = F.when(F.col("label") == F.col("pivot.label"), F.col("other")).otherwise(F.col("pivot"))
    return e.join(others, "token").select("token", "node", "n", "pos", "label", pivot.alias("pivot"))
