"""Run registered queries against their SQL in DuckDB: ``python -m tests.compare [sf] [names]``."""

import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    """None when equal, else a short description."""
    df = fn(spark, sf_dir)
    mine = sorted_rows([tuple(r) for r in df.collect()], df.columns)
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = sorted_rows(cursor.fetchall(), columns)
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None if mine else "no rows"


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", os.environ.get("COMPARE_PARTITIONS", "8"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = duck(sf_dir), entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        if name not in sql:
            continue  # tested against plain versions instead
        start = time.time()
        try:
            result = compare(spark, con, name, fn, sql[name], sf_dir)
        except Exception as error:  # report every query
            result = f"{type(error).__name__}: {str(error)[:400]}"
        bad += result is not None
        print(f"{time.time() - start:6.1f}s {name}: {result or 'ok'}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
