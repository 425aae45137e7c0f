"""Compare registered queries with their SQL. ``python tests/oracle_check.py sf0.01 [name or prefix* ...]``"""

from __future__ import annotations

import fnmatch
import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str):
    import duckdb
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_cell(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(_cell, v)) + "]"
    return str(v)


def normalised(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
              "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def compare(spark, con, folder: str, name: str, query, sql: str | None) -> str:
    """Empty text when all is equal, else what differs."""
    df = query(spark, folder)
    rows = df.collect()
    if sql is None:
        return "" if rows else "no rows"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns differ: {sorted(set(columns) ^ set(df.columns))}"
    kinds = dict(zip(columns, (str(d[1]) for d in result.description)))
    types = [f"{n}: {t} / {kinds[n]}" for n, t in df.dtypes if TYPE_NAMES.get(t, t) != kinds[n] and "[" not in kinds[n] and "array" not in t]
    expected, got = normalised(columns, result.fetchall()), normalised(df.columns, rows)
    if len(expected) != len(got):
        return f"rows: {len(got)} here, {len(expected)} in SQL"
    if expected != got:
        bad = [(a, b) for a, b in zip(got, expected) if a != b]
        names = sorted(columns)
        first = [(names[i], x, y) for i, (x, y) in enumerate(zip(*bad[0])) if x != y]
        return f"{len(bad)} rows differ, first (here, SQL): {first}"
    return f"types differ: {types}" if types else ""


def main() -> int:
    import __spark_entry__ as e
    from demandgrid.session import build_session
    folder = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    wanted = sys.argv[2:] or ["*"]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
                                                 "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = duck(folder), e.oracle_sql(), 0
    for name, query in e.queries().items():
        if not any(fnmatch.fnmatch(name, w) for w in wanted):
            continue
        start = time.time()
        try:
            verdict = compare(spark, con, folder, name, query, oracles.get(name))
        except Exception as error:
            verdict = f"error {type(error).__name__}: {str(error)[:1500]}"
        failed += bool(verdict)
        kind = "sql " if name in oracles else "rows"
        print(f"{name:28s} {kind} {time.time() - start:6.2f}s {verdict or 'ok'}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
