"""Compare Spark queries with their SQL in DuckDB: names, types, rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from spanbill.operators.stage import finish  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "benchmark", "conversations"]


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, [tuple(r) for r in df.select(*names).collect()]


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(r[i] for i in order) for r in cur.fetchall()]


def typed(row: tuple) -> tuple:
    return tuple((type(v).__name__, v) for v in row)


def difference(names, left, right) -> str | None:
    """None when both sides hold the same rows, with the same Python types."""
    a, b = Counter(map(typed, left)), Counter(map(typed, right))
    if a == b:
        return None
    only_a, only_b = list((a - b).elements()), list((b - a).elements())
    lines = [f"spark {len(left)} rows, sql {len(right)} rows; only spark {len(only_a)}, only sql {len(only_b)}"]
    for label, rows in (("spark", only_a), ("sql  ", only_b)):
        for row in sorted(rows, key=repr)[:3]:
            lines.append(f"  {label} " + str({n: v[1] for n, v in zip(names, row)}))
    if only_a and only_b:
        x, y = sorted(only_a, key=repr)[0], sorted(only_b, key=repr)[0]
        lines.append("  columns: " + str([(n, p, q) for n, p, q in zip(names, x, y) if p != q]))
    return "\n".join(lines)


def check(spark, con, sf_dir: str, name: str, job, sql: str | None) -> str | None:
    df = job(spark, sf_dir)
    names, rows = spark_rows(df)
    finish(df)
    if sql is None:
        return None
    other, expected = duck_rows(con, sql)
    if names != other:
        return f"columns differ: only spark {set(names) - set(other)}, only sql {set(other) - set(names)}"
    return difference(names, rows, expected)


if __name__ == "__main__":
    import __spark_entry__ as entry_point
    from spanbill.session import get_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = get_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(sf_dir), entry_point.oracle_sql(), 0
    for name, job in entry_point.queries().items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            problem = check(spark, con, sf_dir, name, job, oracle.get(name))
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - t:.1f}s{'' if name in oracle else ' (no sql)'}", flush=True)
        if problem:
            print(problem, flush=True)
    print("mismatches", bad, "missing", set(oracle) ^ set(entry_point.queries()))
    spark.stop()
