"""Comparison of Spark and DuckDB results, row by row in any order."""

import os

import duckdb
import pyarrow as pa


def connect(sf_dir):
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        con.sql(f"create view {name} as select * from '{sf_dir}/{file}'")
    return con


def table_of(arrow: pa.Table):
    names = sorted(arrow.column_names)
    frame = arrow.select(names).to_pandas()
    return frame.sort_values(names, ignore_index=True)


def assert_same(spark_df, con, sql):
    import pandas as pd

    ours = spark_df.toArrow()
    theirs = con.sql(sql).to_arrow_table()
    kinds = lambda t: {f.name: str(f.type).replace("large_", "") for f in t.schema}
    assert kinds(ours) == kinds(theirs)
    assert ours.num_rows == theirs.num_rows
    pd.testing.assert_frame_equal(table_of(ours), table_of(theirs), check_exact=True)
