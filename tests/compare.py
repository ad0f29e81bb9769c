"""Run registered queries and their SQL side by side and compare values."""
import sys
import time

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf):
    con = duckdb.connect()
    con.execute("set enable_progress_bar=false")
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def canonical(df):
    cols = sorted(df.columns)
    out = pd.DataFrame({c: [repr(None) if v is None or v is pd.NA or v != v else repr(v.item() if hasattr(v, "item") else v) for v in df[c]] for c in cols})
    return out.sort_values(cols).reset_index(drop=True)


def difference(a, b):
    if sorted(a.columns) != sorted(b.columns):
        return f"columns {sorted(a.columns)} / {sorted(b.columns)}"
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    x, y = canonical(a), canonical(b)
    if x.equals(y):
        return None
    bad = (x != y).any(axis=1)
    return f"{int(bad.sum())} rows differ\n{x[bad].head(3).to_string()[:1500]}\n{y[bad].head(3).to_string()[:1500]}"


def compare(spark, con, sf, names=None):
    import __spark_entry__ as entry

    sqls = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            got = pd.DataFrame(*(lambda d: ([tuple(r) for r in d.collect()], None, d.columns))(fn(spark, sf)))
            mid = time.time()
            problem = difference(got, con.sql(sqls[name]).df()) if name in sqls else None
        except Exception as exc:  # noqa: BLE001
            mid, problem, got = time.time(), f"{type(exc).__name__}: {str(exc)[:700]}", []
        yield name, len(got), mid - started, time.time() - mid, problem


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from veilnote.session import build_session

    session = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    sf = sys.argv[1]
    bad = 0
    for name, n, t1, t2, problem in compare(session, connect(sf), sf, sys.argv[2:]):
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={n} spark={t1:.1f}s sql={t2:.1f}s {problem or ''}", flush=True)
    print("failures", bad)
