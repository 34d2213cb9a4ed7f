"""Capture-file source: frame server-sent-event (SSE) captures into events.

Framing rules (those of the live stream client):
* every line is stripped of surrounding white space; a blank line ends an event;
* ``event:``, ``id:`` and ``data:`` lines are recognised, all others ignored;
* empty ``data:`` parts are skipped, several parts are joined with ``\\n``;
* an event is emitted only when its terminating blank line was seen, so the
  unterminated tail of a capture is dropped;
* a payload that is not valid JSON is flagged (``is_valid = false``) and left
  out by :func:`valid_events` -- one bad event never stops the stream.

Scale: captures are read line by line (``spark.read.text``), so a capture file
is split across as many tasks as any text file and no row ever holds a whole
file. The event an input line belongs to is the number of blank lines before
it in its file: a running count inside each file split (a window over one
split, the normal task unit) plus the blank lines of all earlier splits of the
same file (a prefix sum over a table with one row per split). Lines are then
grouped per event, and only ``data``/``event``/``id`` lines of terminated events
take part in that shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulse.operators.parse import is_valid_json

# --- fixed values: the characters Python's str.strip() removes ----------------
# (str.isspace): tab, LF, VT, FF, CR, FS, GS, RS, US, space, NEL, NBSP,
# U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
_WS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
       + "".join(chr(c) for c in range(0x2000, 0x200B))
       + "\u2028\u2029\u202f\u205f\u3000")


def _strip(c):
    """Strip surrounding white space as Python's ``str.strip()`` does
    (a plain character-set trim, no regular expression)."""
    return F.btrim(c, F.lit(_WS))


def _field(line, name: str):
    """Value of a ``name:`` line (stripped), else null."""
    prefix = f"{name}:"
    return F.when(line.startswith(prefix), _strip(F.substring(line, len(prefix) + 1, 1 << 30)))


def frame_lines(lines: DataFrame) -> DataFrame:
    """Frame a DataFrame of capture lines: ``file, split, pos, line`` where
    ``(split, pos)`` orders the lines of one file."""
    line = _strip(F.col("line"))
    marked = lines.select("file", "split", "pos", line.alias("line"),
                          (line == "").alias("blank"))
    in_split = Window.partitionBy("file", "split").orderBy("pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    marked = marked.withColumn("blanks_upto", F.sum(F.col("blank").cast("long")).over(in_split))

    # One row per file split: blank lines in earlier splits and in the whole
    # file (a second, cheap pass: scan + partial count, one row per split
    # shuffled; the windowed branch cannot be reused because line positions
    # are nondeterministic expressions).
    per_split = lines.select("file", "split", (_strip(F.col("line")) == "").alias("blank")) \
        .groupBy("file", "split").agg(F.count_if("blank").alias("n_blank"))
    by_file = Window.partitionBy("file").orderBy("split")
    per_split = per_split.select(
        "file", "split",
        F.coalesce(F.sum("n_blank").over(by_file.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("blanks_before"),
        F.sum("n_blank").over(Window.partitionBy("file")).alias("blanks_in_file"),
    )

    block = F.col("blanks_before") + F.col("blanks_upto") - F.col("blank").cast("long")
    data = _field(F.col("line"), "data")
    event = _field(F.col("line"), "event")
    ident = _field(F.col("line"), "id")
    useful = (marked.join(per_split, ["file", "split"])
              .select("file", block.alias("block"), F.struct("split", "pos").alias("at"),
                      F.when(data != "", data).alias("data"), event.alias("event"), ident.alias("id"),
                      F.col("blanks_in_file"))
              .filter(F.col("block") < F.col("blanks_in_file"))          # terminated events only
              .filter(F.col("data").isNotNull() | F.col("event").isNotNull() | F.col("id").isNotNull()))

    parts = F.array_sort(F.collect_list(F.when(F.col("data").isNotNull(), F.struct("at", "data"))))
    events = useful.groupBy("file", "block").agg(
        F.array_join(F.transform(parts, lambda x: x["data"]), "\n").alias("payload"),
        F.max_by("event", F.when(F.col("event").isNotNull(), F.col("at"))).alias("sse_event"),
        F.max_by("id", F.when(F.col("id").isNotNull(), F.col("at"))).alias("sse_id"),
    )
    value = _strip(F.col("payload"))
    return (events.filter(value != "")
            .select("file", "block", value.alias("value"), "sse_event", "sse_id",
                    F.coalesce(is_valid_json(value), F.lit(False)).alias("is_valid")))


def capture_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of capture files with their file, split and in-split position."""
    raw = spark.read.text(path)
    return raw.select(F.input_file_name().alias("file"), F.input_file_block_start().alias("split"),
                      F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))


def sse_events(spark: SparkSession, path: str) -> DataFrame:
    """Events of SSE capture files: ``file, block, value, sse_event, sse_id, is_valid``
    (``(file, block)`` gives stream order)."""
    return frame_lines(capture_lines(spark, path))


def valid_events(events: DataFrame) -> DataFrame:
    """Framed events whose payload parsed as JSON, as ``value`` records."""
    return events.filter("is_valid").select(F.col("value").cast("binary").alias("value"), "file", "block")
