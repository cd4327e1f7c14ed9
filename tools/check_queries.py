"""Run queries and compare them with their SQL: ``check_queries.py [sf_dir] [name-prefix ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from tabloom.queries import ORACLES, QUERIES  # noqa: E402
from tabloom.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TIMES: dict[str, float] = {}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def canonical(frame) -> list[tuple]:
    """Rows as text with columns by name, sorted."""
    frame = frame[sorted(frame.columns)]
    rows = []
    for row in frame.itertuples(index=False):
        cells = []
        for v in row:
            if v is None or v != v:
                cells.append("null")
            elif isinstance(v, float):
                cells.append(repr(v + 0.0))
            else:
                cells.append(str(v))
        rows.append(tuple(cells))
    return sorted(rows)


def compare(spark, con, sf: str, name: str) -> str:
    start = time.time()
    got = QUERIES[name](spark, sf).toPandas()
    TIMES[name] = time.time() - start
    if name not in ORACLES:
        return f"rows {len(got)}" if len(got) else "EMPTY"
    want = con.execute(ORACLES[name]).fetchdf()
    if sorted(got.columns) != sorted(want.columns):
        return f"COLUMNS {sorted(got.columns)} vs {sorted(want.columns)}"
    kinds = {
        c: (got[c].dtype.kind, want[c].dtype.kind) for c in got.columns
        if got[c].dtype.kind != want[c].dtype.kind
    }
    a, b = canonical(got), canonical(want)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        return f"DIFF rows {len(a)} vs {len(b)}; spark only {str(only_a[:4])[:500]}; sql only {str(only_b[:4])[:500]}"
    return f"ok {len(a)}" + (f" KINDS {kinds}" if kinds else "") + ("" if len(a) else " EMPTY")


def main() -> int:
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [n for n in QUERIES if not args or any(n.startswith(p) for p in args)]
    spark, con, bad = local_session("8"), connect(sf), 0
    spark.sparkContext.setLogLevel("OFF")
    for name in names:
        start = time.time()
        try:
            result = compare(spark, con, sf, name)
        except Exception as error:  # noqa: BLE001
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        good = result.startswith(("ok", "rows")) and "EMPTY" not in result
        bad += not good
        print(f"{'   ' if good else '!! '}{name:32s} {TIMES.get(name, 0):6.2f}s +{time.time() - start - TIMES.get(name, 0):5.2f}s {result}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
