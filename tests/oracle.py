"""Compare a query with its SQL on the same tables: python tests/oracle.py SF_DIR [name …]."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def plain(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, bool):
        return str(int(value))
    return None if value is None else str(value)


def expected(sf_dir: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())


def actual(df):
    names = sorted(df.columns)
    return names, Counter(tuple(plain(r[n]) for n in names) for r in df.collect())


def compare(df, sf_dir: str, sql: str) -> str | None:
    """None when equal, else what differs."""
    (names, got), (wanted_names, wanted) = actual(df), expected(sf_dir, sql)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if got != wanted:
        return (f"{sum(got.values())} rows, expected {sum(wanted.values())}\n"
                f"  only here: {list((got - wanted).items())[:3]}\n  only there: {list((wanted - got).items())[:3]}")
    return None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles, bad = entry.queries(), entry.oracle_sql(), 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = compare(df, sf_dir, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as exc:  # report and go on
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        ok = problem is None or problem.startswith("rows only")
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
