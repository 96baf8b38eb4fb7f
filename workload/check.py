"""Run queries against their SQL twins: ``python -m workload.check DIR [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import numpy as np
import pandas as pd

from gridlake.session import build_session
from workload import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def canonical(table) -> pd.DataFrame:
    frame = table.to_pandas(date_as_object=False)
    frame = frame[sorted(frame.columns)]
    for c in frame.columns:
        if frame[c].dtype.kind == "M":
            frame[c] = frame[c].astype("datetime64[us]")
    return frame.sort_values(list(frame.columns), kind="stable", na_position="last").reset_index(drop=True)


def differences(got, want) -> str:
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} against {sorted(want.column_names)}"
    kinds = []
    for c in sorted(got.column_names):
        a, b = (str(t.schema.field(c).type).replace("large_", "") for t in (got, want))
        if a != b:
            kinds.append(f"{c}: {a} against {b}")
    if kinds:
        return "types " + "; ".join(kinds)
    if got.num_rows != want.num_rows:
        return f"rows {got.num_rows} against {want.num_rows}"
    a, b = canonical(got), canonical(want)
    for c in a.columns:
        x, y = a[c], b[c]
        same = (x == y) | (x.isna() & y.isna())
        if not same.all():
            i = int(np.argmin(same.to_numpy()))
            return f"{(~same).sum()} values of {c}, first at {i}: {x[i]!r} against {y[i]!r}\n{a.iloc[i]}\n{b.iloc[i]}"
        if x.dtype.kind == "f" and (np.signbit(x.fillna(1)) != np.signbit(y.fillna(1))).any():
            return f"sign of zero in {c}"
    return ""


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toArrow()
            took = time.time() - start
            if name in ORACLES:
                want = con.sql(ORACLES[name]).to_arrow_table()
                result = differences(got, want)
                label = "ok" if not result else "DIFFERS"
            else:
                result, label = "", "no twin"
            print(f"{label:8} {name:34} {got.num_rows:8} rows {took:6.2f}s {result}", flush=True)
            bad += label == "DIFFERS"
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR    {name}: {type(e).__name__} {str(e)[:1500]}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
