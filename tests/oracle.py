"""A query's rows against its SQL's, on the same Parquet files."""

import os

import duckdb


def rows_of(names, rows):
    by = sorted(range(len(names)), key=lambda i: names[i])

    def plain(v):
        if v is None or isinstance(v, (bool, str)):
            return v
        if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
            return float(v)
        return str(v)

    return sorted((tuple(plain(r[i]) for i in by) for r in rows), key=repr)


def check(spark, sf_dir, query, sql):
    got = query(spark, sf_dir)
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for f in os.listdir(sf_dir):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{sf_dir}/{f}'")
    want = con.sql(sql)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(want.columns, want.fetchall())
