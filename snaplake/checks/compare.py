"""Side-by-side run of a registered query in Spark and its SQL twin in DuckDB, compared
the way the correctness gate does: row count, column names, order-insensitive value
hash over columns sorted by name."""

from __future__ import annotations

import hashlib
import os

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def digest(cols, rows) -> tuple[str, list[str]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(repr(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> dict:
    df = query(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    rec = {"q": name, "rows": [len(srows)], "cols": list(df.columns)}
    if sql is None:
        rec["ok"] = None
        return rec
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    hs, ls = digest(df.columns, srows)
    hd, ld = digest(dcols, drows)
    rec["rows"].append(len(drows))
    rec["ok"] = (len(srows) == len(drows) and sorted(df.columns) == sorted(dcols)
                 and hs == hd)
    if not rec["ok"]:
        rec["duck_cols"] = dcols
        rec["only_spark"] = sorted(set(ls) - set(ld))[:3]
        rec["only_duck"] = sorted(set(ld) - set(ls))[:3]
    return rec
