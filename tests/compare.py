"""Run registered queries and their SQL side by side: python tests/compare.py SF_DIR [name ...]."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, oracle: str) -> str | None:
    """None if both sides hold the same rows, else a short description."""
    got_columns = df.columns
    got = _rows(got_columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(oracle)
    columns = [d[0] for d in cursor.description]
    want = _rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(got_columns):
        return f"columns {sorted(got_columns)} != {sorted(columns)}"
    if got != want:
        extra, missing = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
        return f"{len(got)} rows != {len(want)}; only here {str(extra)[:400]}; only there {str(missing)[:400]}"
    return None


def main() -> None:
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    import __spark_entry__ as entry
    from capledger.session import build_session

    root, names = sys.argv[1], sys.argv[2:] or list(entry.queries())
    spark = build_session(
        "compare", master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("OFF")
    con, oracles, bad = connect(root), entry.oracle_sql(), 0
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, root)
            problem = difference(df, con, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
