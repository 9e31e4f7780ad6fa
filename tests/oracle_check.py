"""Run registered queries next to their SQL in DuckDB and compare names, row counts and values."""

from __future__ import annotations

import datetime
import decimal
import math
import pathlib
import sys
import time

import duckdb

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def compare(spark, con, query, sql, sf_dir) -> str | None:
    df = query(spark, sf_dir)
    ours = table(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    theirs = table([d[0] for d in cur.description], cur.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} vs {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} vs {len(theirs[1])}: {ours[1][:3]} vs {theirs[1][:3]}"
    if not ours[1]:
        return "both empty"
    bad = [(a, b) for a, b in zip(ours[1], theirs[1]) if repr(a) != repr(b)]
    if bad:
        return f"{len(bad)} of {len(ours[1])} rows differ, e.g. {str(bad[0][0])[:400]} vs {str(bad[0][1])[:400]}"
    return None


def session(cpus: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    import __spark_entry__ as entry

    sf, wanted = sys.argv[1], sys.argv[2:]
    sf_dir = sf if sf.startswith("/") else f"/root/testdata/{sf}"
    spark, con = session(), duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not wanted or any(n == w or (w.endswith("*") and n.startswith(w[:-1])) for w in wanted)]
    failed = []
    for n in names:
        start = time.time()
        try:
            if n in oracles:
                problem = compare(spark, con, queries[n], oracles[n], sf_dir)
            else:
                rows = queries[n](spark, sf_dir).collect()
                problem = None if rows else "no rows"
                print("   rows", len(rows), str(rows[0])[:160] if rows else "")
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {n} {time.time() - start:.2f}s {problem or ''}", flush=True)
        if problem:
            failed.append(n)
    print("failed:", failed, "of", len(names))
