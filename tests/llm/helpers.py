"""Shared small helpers of these tests."""

from check import connect, rows_of

from phonolake.llm import registry

SF = "/root/testdata/sf0.001"


def same_as_sql(spark, name, sf_dir=SF):
    df = registry.QUERIES[name](spark, sf_dir)
    cur = connect(sf_dir).execute(registry.SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cur.fetchall())


def run_on(spark, tmp_path, name, **tables):
    """The registered query over own tables: name=(rows, schema)."""
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/{table}.parquet")
    return registry.QUERIES[name](spark, str(tmp_path)).collect()
