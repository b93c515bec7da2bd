"""Run registered queries beside their SQL and compare names, types, rows and values."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return repr(v)

    return sorted(tuple(value(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None if both give the same result, else what differs."""
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    ours = dict(df.dtypes)
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} vs {sorted(theirs)}"
    kinds = {c: (ours[c], theirs[c]) for c in ours if KINDS.get(ours[c], ours[c]) != theirs[c]}
    if kinds:
        return f"types {kinds}"
    actual = [tuple(r) for r in df.collect()]
    if len(actual) != len(expected):
        return f"{len(actual)} rows vs {len(expected)}"
    a, b = _canonical(actual, df.columns), _canonical(expected, list(theirs))
    if a != b:
        wrong = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
        return f"{len(wrong)} rows differ, first {wrong[0]}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from tidemart.session import local_session

    spark = local_session(8)
    con, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if names and not any(n in name for n in names):
            continue
        began = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                problem = difference(df, con, sqls[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # report every query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:32s} {time.time() - began:6.2f}s "
              f"{'' if name in sqls else '(rows only) '}{problem or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
