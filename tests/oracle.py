"""Run queries against their SQL equivalents: python tests/oracle.py SF_DIR [name ...]"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return (1, "nan") if isinstance(value, float) and math.isnan(value) else (2, float(value))
    return (3, str(value))


def compare(df, con, sql, tolerance=0.0):
    """None when equal, else a description of the first difference."""
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.select(*[f"`{c}`" for c in columns]).collect()),
                 key=lambda r: tuple(map(_key, r)))
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=lambda r: tuple(map(_key, r)))
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        for c, x, y in zip(columns, a, b):
            if x == y and isinstance(x, bool) == isinstance(y, bool):
                continue
            both = isinstance(x, (int, float)) and isinstance(y, (int, float))
            if both and abs(x - y) <= tolerance * max(1.0, abs(x)):
                continue
            return f"{c}: {x!r} != {y!r} in {a} / {b}"
    return None


def main():
    from pyspark.sql import SparkSession
    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in wanted or queries:
        begin = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                problem = compare(df, con, oracle[name])
                if problem and compare(df, con, oracle[name], 1e-9) is None:
                    problem = "TOLERANCE " + problem
            else:
                problem = f"no oracle, {df.count()} rows"
        except Exception as failure:
            problem = f"FAILED {type(failure).__name__}: {str(failure)[:1500]}"
        bad += bool(problem) and not str(problem).startswith("no oracle")
        print(f"{name:34s} {time.time() - begin:6.1f}s {'ok' if not problem else problem}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
