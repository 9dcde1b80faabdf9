"""Run the registered queries beside their SQL and compare the rows.

``python tests/compare.py [scale folder] [query ...]``
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
        if isinstance(v, bool) or v is None:
            return str(v)
        return str(v)

    def number(v):
        return cell(float(v)) if isinstance(v, int) and not isinstance(v, bool) else cell(v)

    return sorted(tuple(number(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    want = canonical(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if got == want:
        return None
    only_got = [r for r in got if r not in set(want)][:2]
    only_want = [r for r in want if r not in set(got)][:2]
    return f"rows {len(got)} / {len(want)}\n   got  {only_got}\n   want {only_want}"


def main() -> int:
    from farelens.plans import catalog, oracle
    from farelens.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = local_session(8)
    con = connect(sf_dir)
    sql = oracle.statements()
    failed = 0
    for name, query in catalog.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = compare(spark, con, name, query, sql[name], sf_dir)
            else:
                problem = None if query(spark, sf_dir).count() else "no rows"
        except Exception as err:  # report and go on to the next query
            problem = f"{type(err).__name__}: {str(err)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
