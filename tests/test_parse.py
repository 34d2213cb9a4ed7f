import json

from pyspark.sql import functions as F

from pulse.operators import parse as P


def _msgs(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_standard_columns(spark):
    ev = {"meta": {"dt": "2024-01-01T00:00:07.179Z", "domain": "en.wikipedia.org",
                   "stream": "mediawiki.revision-create"},
          "type": "edit", "wiki": "enwiki", "title": "T", "user": "u", "comment": "c",
          "namespace": 0, "minor": True}
    out = P.parse_events(_msgs(spark, [json.dumps(ev)])).collect()[0]
    assert out.event_time.isoformat().startswith("2024-01-01T00:00:07.179")
    assert (out.domain, out.stream, out.event_type, out.wiki) == (
        "en.wikipedia.org", "mediawiki.revision-create", "edit", "enwiki")
    assert out.bot is False and out.minor is True and out.rev_content_changed is False
    assert out.raw_json == json.dumps(ev)
    assert len(P.parse_events(_msgs(spark, ["{}"])).columns) == 13


def test_parse_binary_value(spark):
    df = spark.createDataFrame([(bytearray(b'{"type":"log"}'),)], "value binary")
    assert P.parse_events(df).collect()[0].event_type == "log"


def test_malformed_json_gives_null_fields_not_errors(spark):
    values = ["not json", '{"type": "edit"', "", '{"meta": null, "type": "x"}',
              '{"bot": "yes", "type": "y"}', '{"namespace": 99999999999, "type": "z"}',
              '{"user": {"name": "a"}, "type": "w"}', None]
    rows = P.parse_events(_msgs(spark, values)).collect()
    assert len(rows) == len(values)
    by_raw = {r.raw_json: r for r in rows}
    assert by_raw["not json"].event_type is None and by_raw["not json"].bot is False
    assert by_raw['{"meta": null, "type": "x"}'].domain is None
    assert by_raw['{"meta": null, "type": "x"}'].event_type == "x"
    assert by_raw['{"bot": "yes", "type": "y"}'].bot is False
    assert by_raw['{"namespace": 99999999999, "type": "z"}'].namespace is None
    assert json.loads(by_raw['{"user": {"name": "a"}, "type": "w"}'].user) == {"name": "a"}


def test_event_time_shapes(spark):
    cases = {
        "2024-01-01T00:00:07.179Z": "2024-01-01 00:00:07.179000",
        "2024-01-01T00:00:07Z": "2024-01-01 00:00:07",
        "2024-01-01T00:00:07.123456Z": "2024-01-01 00:00:07.123456",
        "2024-01-01T00:00:07+00:00": "2024-01-01 00:00:07",
        "2024-01-01T09:00:07+09:00": "2024-01-01 00:00:07",
        "junk": None,
    }
    vals = [json.dumps({"meta": {"dt": k}}) for k in cases] + ['{"meta": {}}']
    rows = P.parse_events(_msgs(spark, vals)).select(
        "raw_json", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t")).collect()
    got = {json.loads(r.raw_json)["meta"].get("dt"): r.t for r in rows}
    for k, want in cases.items():
        if want is None:
            assert got[k] is None
        else:
            assert got[k].rstrip("0").rstrip(".") == want.rstrip("0").rstrip(".")
    assert got[None] is None


def test_routing_and_subscription(spark):
    vals = ['{"meta": {"stream": "mediawiki.recentchange"}}',
            '{"meta": {"stream": "mediawiki.revision-create"}}',
            '{"meta": {"stream": "other"}}', '{"meta": null}', '{"type": "x"}', "[1,2]", "not json"]
    routed = P.with_topic(_msgs(spark, vals)).collect()
    topics = [r.topic for r in routed]
    assert topics == ["wiki-recentchange", "wiki-revision-create"] + ["wiki-unknown"] * 5
    sub = P.subscribed(P.with_topic(_msgs(spark, vals)), ["wiki-recentchange", "wiki-revision-create"])
    assert sub.count() == 2


def test_valid_and_malformed_split(spark):
    vals = ['{"a": 1}', "{bad", "", None, "[1]", '"s"']
    df = _msgs(spark, vals)
    valid = {r.value for r in P.valid_json(df).collect()}
    bad = [r.value for r in P.malformed_json(df).collect()]
    assert valid == {'{"a": 1}', "[1]", '"s"'}
    assert sorted(bad, key=str) == sorted(["{bad", "", None], key=str)


def test_revisions_only_and_to_value(spark):
    df = P.parse_events(_msgs(spark, ['{"meta": {"stream": "mediawiki.revision-create"}}',
                                      '{"meta": {"stream": "mediawiki.recentchange"}}']))
    assert P.revisions_only(df).count() == 1
    assert {r.value for r in P.to_value(df).collect()} == {
        '{"meta": {"stream": "mediawiki.revision-create"}}', '{"meta": {"stream": "mediawiki.recentchange"}}'}


def test_parse_once_plan(spark):
    """The window null-filter must not re-evaluate from_json below the parse."""
    from pulse.operators import metrics as M

    df = M.total_events(P.parse_events(_msgs(spark, ['{"meta": {"dt": "2024-01-01T00:00:00.000Z"}}'])))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_parse_only_requested_columns(spark):
    ev = '{"meta": {"dt": "2024-01-01T00:00:01.000Z", "domain": "d", "stream": "s", "uri": "u"}, ' \
         '"type": "edit", "title": "t", "bot": true}'
    df = P.parse_events(_msgs(spark, [ev]), columns=["event_type", "bot"])
    assert df.columns == ["event_time", "stream", "event_type", "bot"]
    row = df.collect()[0]
    assert (row.stream, row.event_type, row.bot) == ("s", "edit", True)
    assert P.pruned_schema(["event_time", "bot"]).simpleString() == "struct<meta:struct<dt:string>,bot:boolean>"
    full = P.parse_events(_msgs(spark, [ev])).collect()[0]
    assert (full.event_time, full.event_type) == (row.event_time, row.event_type)
