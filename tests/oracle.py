"""Side-by-side comparison of a registered query and its SQL."""

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "STRING": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "NUMBER": "number"}


def database(root):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in data)


def compare(spark, con, run, sql, root):
    df = run(spark, root)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = rows(names, cur.fetchall())
    assert sorted(df.columns) == sorted(names)
    types = {c[0]: TYPES.get(str(c[1]), str(c[1])) for c in cur.description}
    assert dict(df.dtypes) == types
    assert len(got) == len(want), (len(got), len(want))
    for g, w in zip(got, want):
        assert g == w, (g, w)
    return len(got)
