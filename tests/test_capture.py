import json

from pulse.sources.capture import sse_events, valid_events

CAPTURE = (
    ": keep-alive comment\n"
    "event: message\nid: [{\"topic\":\"a\",\"partition\":0}]\ndata: {\"a\": 1}\n\n"
    "data: {\"b\":\ndata:  2}\n   \n"          # two parts, whitespace-only separator
    "\n\n"                                      # extra blank lines: nothing
    "data:\n\n"                                 # empty data: skipped
    "data: not json\r\n\r\n"                    # CRLF, bad JSON: flagged
    "event: x\nid: 9\nid: 10\ndata: {\"c\": 3}\n\n"
    "event: tail\ndata: {\"d\": 4}\n"           # unterminated: dropped
)


def _frames(spark, tmp_path, text, name="cap.txt"):
    (tmp_path / name).write_text(text)
    return sorted(sse_events(spark, str(tmp_path)).collect(), key=lambda r: (r.file, r.block))


def test_framing_rules(spark, tmp_path):
    rows = _frames(spark, tmp_path, CAPTURE)
    assert [r.value for r in rows] == ['{"a": 1}', '{"b":\n2}', "not json", '{"c": 3}']
    assert [r.is_valid for r in rows] == [True, True, False, True]
    assert rows[0].sse_event == "message" and json.loads(rows[0].sse_id)[0]["topic"] == "a"
    assert rows[3].sse_event == "x" and rows[3].sse_id == "10"
    assert [json.loads(r.value.decode()) for r in valid_events(
        sse_events(spark, str(tmp_path))).orderBy("block").collect()] == [{"a": 1}, {"b": 2}, {"c": 3}]


def test_framing_across_file_splits(spark, tmp_path):
    """A capture cut into many tiny splits frames exactly like one split."""
    events = [f'event: message\ndata: {{"i": {i},\ndata: "pad": "{"x" * (i % 13)}"}}\n\n' for i in range(300)]
    text = "".join(events) + "data: {\"tail\": 1}\n"
    whole = [(r.value, r.is_valid) for r in _frames(spark, tmp_path, text)]
    prev = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        split = [(r.value, r.is_valid) for r in _frames(spark, tmp_path, text)]
        from pulse.sources.capture import capture_lines
        assert capture_lines(spark, str(tmp_path)).select("split").distinct().count() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)
    assert len(whole) == 300 and split == whole
    assert [json.loads(v)["i"] for v, _ in whole] == list(range(300))


def test_two_files_and_empty_capture(spark, tmp_path):
    (tmp_path / "a.txt").write_text('data: {"f": 1}\n\n')
    (tmp_path / "b.txt").write_text('data: {"f": 2}\n\ndata: {"f": 3}')
    (tmp_path / "c.txt").write_text("")
    rows = sse_events(spark, str(tmp_path)).collect()
    assert sorted(r.value for r in rows) == ['{"f": 1}', '{"f": 2}']


def test_strip_matches_python(spark):
    from pyspark.sql import functions as F

    from pulse.sources.capture import _strip

    samples = ["  data: x \t", "　event: e\x1c", "\xa0 id: 7 ", "\x85", "plain", ""]
    got = [r.s for r in spark.createDataFrame([(s,) for s in samples], "v string")
           .select(_strip(F.col("v")).alias("s")).collect()]
    assert got == [s.strip() for s in samples]
