"""Compare every registered query with its DuckDB oracle (like the driver).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    import datetime as dt

    import numpy as np
    import pandas as pd

    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        ts = pd.Timestamp(v)
        if ts.tzinfo is not None:
            ts = ts.tz_convert("UTC").tz_localize(None)
        return ts.isoformat()
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.floating, float)):
        return round(float(v), 9)
    if isinstance(v, (np.bool_,)):
        return bool(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(r[c]) for c in cols) for _, r in pdf.iterrows()]
    return cols, sorted(out, key=repr)


SPARK_TO_DUCK = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "DoubleType()": "DOUBLE",
                 "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN", "TimestampType()": "TIMESTAMP"}


def type_mismatches(sdf, rel):
    st = {f.name: SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in sdf.schema.fields}
    dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}


def compare(spark, sf_dir: str, names=None):
    import __spark_entry__ as E

    qs, oracles = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or qs:
        t = time.time()
        try:
            frame = qs[name](spark, sf_dir)
            sdf = frame.toPandas()
        except Exception as e:      # report the query and go on
            results[name] = (f"ERROR {str(e)[:300]}", 0, time.time() - t)
            continue
        ts = time.time() - t
        if name not in oracles:
            results[name] = ("no-oracle", len(sdf), ts)
            continue
        odf = con.execute(oracles[name]).fetchdf()
        types = type_mismatches(frame, con.sql(oracles[name]))
        if types:
            results[name] = (f"TYPES {types}", len(sdf), ts)
            continue
        sc, sr = rows(sdf)
        oc, orr = rows(odf)
        if sc != oc:
            results[name] = (f"COLUMNS spark={sc} oracle={oc}", len(sdf), ts)
        elif sr != orr:
            diff = [(a, b) for a, b in zip(sr, orr) if a != b][:3]
            results[name] = (f"VALUES rows {len(sr)} vs {len(orr)} first diffs {diff}", len(sdf), ts)
        else:
            results[name] = ("ok", len(sdf), ts)
    return results


if __name__ == "__main__":
    from pulse.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = 0
    for k, (status, n, secs) in res.items():
        print(f"{k:32s} {n:7d} rows {secs:6.2f}s  {status}")
        bad += status not in ("ok", "no-oracle")
    print("FAILED" if bad else "ALL OK", bad)
