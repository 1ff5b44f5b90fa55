"""Run queries against DuckDB: python -m tests.oracle [name…] [--sf 0.01] [--threads 1]"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import time
import traceback
from concurrent.futures import ThreadPoolExecutor

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return None if math.isnan(value) else ("float", value + 0.0)
    if isinstance(value, decimal.Decimal):
        return ("decimal", float(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return ("time", str(value))
    if isinstance(value, (list, tuple)):
        return ("list", tuple(_cell(v) for v in value))
    return ("text", value)


def canonical(names, rows):
    """Rows with columns in name order, sorted."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def difference(got, wanted) -> str | None:
    """What differs between two canonical tables, or None."""
    if got[0] != wanted[0]:
        return f"columns {got[0]} != {wanted[0]}"
    if len(got[1]) != len(wanted[1]):
        return f"{len(got[1])} rows != {len(wanted[1])}"
    bad = [(g, w) for g, w in zip(got[1], wanted[1]) if g != w]
    if bad:
        return f"{len(bad)} of {len(got[1])} rows differ, first\n   got    {bad[0][0]}\n   wanted {bad[0][1]}"
    return None


def check(spark, con, name, function, sql, sf_dir):
    """(seconds, rows, difference or None)."""
    started = time.time()
    frame = function(spark, sf_dir)
    rows = frame.collect()
    seconds = time.time() - started
    if sql is None:
        return seconds, len(rows), None if rows else "no rows"
    result = con.execute(sql)
    wanted = canonical([d[0] for d in result.description], result.fetchall())
    return seconds, len(rows), difference(canonical(frame.columns, [tuple(r) for r in rows]), wanted)


def check_all(spark, sf_dir, queries, oracles, threads, report=lambda *_: None):
    """{name: difference or None}, several queries at a time; a failing query's difference is its traceback."""
    con = connect(sf_dir)

    def one(item):
        name, function = item
        try:
            seconds, rows, bad = check(spark, con.cursor(), name, function, oracles.get(name), sf_dir)
        except Exception:
            seconds, rows, bad = 0.0, 0, traceback.format_exc(limit=-4)[:3000]
        report(name, "sql" if name in oracles else "rows", seconds, rows, bad)
        return name, bad

    with ThreadPoolExecutor(max_workers=threads) as pool:
        return dict(pool.map(one, queries.items()))


def main():
    from __spark_entry__ import oracle_sql, queries
    from tallyloom.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--threads", type=int, default=1)
    args = parser.parse_args()
    spark = local_session()
    spark.sparkContext.setLogLevel("OFF")
    todo = {n: f for n, f in queries().items() if not args.names or any(n.startswith(a) for a in args.names)}

    def report(name, kind, seconds, rows, bad):
        print(f"{'FAIL' if bad else 'ok  '} {kind:4} {seconds:6.2f}s {rows:7d} {name}" + (f"\n   {bad}" if bad else ""), flush=True)

    found = check_all(spark, f"/root/testdata/sf{args.sf}", todo, oracle_sql(), args.threads, report)
    failed = [n for n, bad in found.items() if bad]
    print(f"{len(todo) - len(failed)}/{len(todo)} passed; failed: {failed}")


if __name__ == "__main__":
    main()
