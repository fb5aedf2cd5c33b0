"""Compare a Spark result with DuckDB's, as sets of rows with columns in name order."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


SAME = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: [(x is None, str(x)) for x in r]
    )


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_cols, want = [d[0] for d in cur.description], cur.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    spark_types = {f.name: SAME.get(f.dataType.simpleString()) for f in df.schema}
    duck_types = {d[0]: str(d[1]) for d in cur.description}
    if spark_types != duck_types:
        return "types " + str({c: (spark_types[c], duck_types[c]) for c in duck_types
                               if spark_types[c] != duck_types[c]})
    got, want = normal(got_cols, got), normal(want_cols, want)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}" if bad else None
