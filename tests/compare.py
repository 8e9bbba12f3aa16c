"""Compare a Spark result with SQL run on the same parquet tables."""

from __future__ import annotations

import collections

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(r[i] for i in order) for r in rows)


def compare(df, con, sql):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = bag(names, cur.fetchall())
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    if got != want:
        extra, missing = got - want, want - got
        problems.append(
            f"{sum(got.values())} rows against {sum(want.values())}; "
            f"extra {list(extra.items())[:3]}; missing {list(missing.items())[:3]}"
        )
    return sum(got.values()), problems
