"""Compare registered queries with their SQL: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def session(cpus: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("presswork-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    if isinstance(value, float):
        return round(value, 9)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(_plain(r[i])) for i in order) for r in rows)


SAME_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def difference(spark, con, name, query, sql, sf_dir) -> str:
    """Empty when schema and rows agree."""
    df = query(spark, sf_dir)
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} <> {sorted(names)}"
    types = [
        f"{c}: {t} <> {kinds[c]}" for c, t in df.dtypes if SAME_TYPE.get(t, t) != kinds[c]
    ]
    got = _rows(df.columns, df.collect())
    want = _rows(names, expected)
    if got != want:
        a, b = set(got), set(want)
        return f"{len(got)} rows <> {len(want)}; only here {sorted(a - b)[:2]}; only there {sorted(b - a)[:2]}; types {types}"
    if types:
        return f"types {types}"
    return "" if got else "EMPTY on both sides"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = session(), database(sf_dir)
    sqls = oracle_sql()
    bad = 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            if name in sqls:
                result = difference(spark, con, name, query, sqls[name], sf_dir) or "ok"
            else:
                result = f"rows only: {query(spark, sf_dir).count()}"
        except Exception as error:
            result = f"ERROR {type(error).__name__} {str(error)[:600]}"
        bad += result != "ok" and not result.startswith("rows only")
        print(f"{name:28s} {time.time() - began:6.1f}s {result[:1500]}", flush=True)
    print(f"{bad} differences")


if __name__ == "__main__":
    main()
