"""Command line: python tests/check.py [sf_dir] [query ...] compares and times queries."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle
from pyspark.sql import SparkSession

import __spark_entry__ as entry


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if chosen and name not in chosen:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            got = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print("ERROR", name, str(e)[:1500])
            bad += 1
            continue
        dt = time.time() - t
        if name not in sqls:
            print(f"ROWS  {name:<34} {len(got):>7} rows {dt:6.2f}s")
            continue
        cur = con.execute(sqls[name])
        cols = [d[0] for d in cur.description]
        kinds = dict(zip(cols, [str(d[1]) for d in cur.description]))
        want = cur.fetchall()
        c1, a = oracle.rows(df.columns, got)
        c2, b = oracle.rows(cols, want)
        verdict = "OK" if c1 == c2 and a == b else "DIFF"
        same = verdict == "OK" and oracle.exact(df.columns, got) == oracle.exact(cols, want)
        print(f"{verdict:<5} {name:<34} {len(got):>7} rows {dt:6.2f}s {'exact' if same else 'approx'}"
              f" {[f'{f.name}:{f.dataType.simpleString()}/{kinds.get(f.name)}' for f in df.schema if not compatible(f.dataType.simpleString(), kinds.get(f.name, ''))]}")
        if verdict != "OK":
            bad += 1
            print("   columns", c1, c2, len(got), len(want))
            only_a = [x for x in a if x not in set(b)][:3]
            only_b = [x for x in b if x not in set(a)][:3]
            print("   spark ", only_a)
            print("   duckdb", only_b)
    print("bad:", bad)


PAIRS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


def compatible(spark_type: str, duck_type: str) -> bool:
    return PAIRS.get(spark_type) == duck_type


if __name__ == "__main__":
    main()
