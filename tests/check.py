"""Compare registered queries with their SQL on the same tables.

    python tests/check.py SF_DIR [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def sql_connection(sf_dir: str):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        v = float(v)
        return 0.0 if v == 0 else v
    return str(v)


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(out, key=_key)


def compare(df, con, sql) -> tuple[bool, str]:
    mine = rows_of(df.columns, df.collect())
    res = con.execute(sql)
    theirs = rows_of([d[0] for d in res.description], res.fetchall())
    if mine[0] != theirs[0]:
        return False, f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return False, f"rows {len(mine[1])} != {len(theirs[1])}"
    diff = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    if diff:
        return False, f"{len(diff)} of {len(mine[1])} rows differ, first: {diff[:2]}"
    return True, f"{len(mine[1])} rows"


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lotwise-check")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = session(), sql_connection(sf_dir)
    built, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or built:
        start = time.time()
        try:
            if name in oracle:
                ok, note = compare(built[name](spark, sf_dir), con, oracle[name])
            else:
                n = built[name](spark, sf_dir).count()
                ok, note = n > 0, f"{n} rows (no SQL)"
        except Exception as e:  # report and go on with the next query
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:30s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
