"""Run registered queries and their SQL twins side by side.

    python -m checks.compare [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import time
from datetime import date, datetime

import duckdb

from checks.oracle import oracle_sql
from coldhaul.catalog import queries
from coldhaul.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
KINDS = {"tinyint": "int", "smallint": "int", "integer": "int", "bigint": "int", "int": "int",
         "hugeint": "huge", "double": "double", "varchar": "string", "string": "string",
         "boolean": "boolean", "date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, datetime):
        return v.isoformat(timespec="microseconds")
    if isinstance(v, date):
        return v.isoformat()
    return repr(v) if isinstance(v, float) else str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


SQL = oracle_sql()


def differences(spark, con, name: str, sf_dir: str) -> list[str]:
    """What differs between the Spark result and its twin; nothing if they agree."""
    df = queries()[name](spark, sf_dir)
    spark_types = {f.name: KINDS.get(f.dataType.typeName().replace("long", "bigint"), f.dataType.typeName())
                   for f in df.schema.fields}
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    duck_types = {d[0]: KINDS.get(str(d[1]).lower(), str(d[1]).lower()) for d in cur.description}
    theirs = _rows(columns, cur.fetchall())
    found = []
    if sorted(df.columns) != sorted(columns):
        found.append(f"columns {sorted(df.columns)} vs {sorted(columns)}")
    types = {c: (spark_types[c], duck_types.get(c)) for c in spark_types
             if spark_types[c] != duck_types.get(c)}
    if types:
        found.append(f"types {types}")
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} vs {len(theirs)}")
    if ours != theirs:
        extra = [r for r in ours if r not in set(theirs)][:2]
        missing = [r for r in theirs if r not in set(ours)][:2]
        found.append(f"values {sorted(columns)}\n   spark {extra}\n   duck  {missing}")
    return found


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in args.names or list(queries()):
        started = time.time()
        try:
            found = differences(spark, con, name, sf_dir)
        except Exception as problem:
            found = [f"error {type(problem).__name__}: {str(problem)[:600]}"]
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.time() - started:.1f}s", *found, sep="\n   " if found else " ",
              flush=True)
    print(f"{bad} of {len(args.names or queries())} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
