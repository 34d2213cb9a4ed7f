"""Every registered query against its DuckDB oracle (the driver's check)."""

import pytest

from oracle_check import compare

SF = "/root/testdata/sf0.01"


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "final_type", "cnt"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_a_reason():
    from pulse.plans.catalog import QUERIES
    from pulse.plans.oracles import ORACLES
    from pulse.plans.stream_oracles import ORACLES as STREAM_ORACLES

    assert set(QUERIES) == {*ORACLES, *STREAM_ORACLES}


@pytest.mark.parametrize("sf", [SF])
def test_queries_match_oracles(spark, sf):
    from pulse.plans.catalog import QUERIES

    res = compare(spark, sf, list(QUERIES))
    bad = {k: v[0] for k, v in res.items() if v[0] not in ("ok", "no-oracle")}
    assert not bad, bad
