"""Options, save modes, mapping, rejects, tolerance, merges and external tables on small fixtures."""

import uuid

import pytest
from pyspark.sql import functions as F

from lakespan.sources.bridge import IS_SET, MAX_LENGTH, Bridge
from lakespan.sources.errors import ExternalTableError, MergeError, OptionError, SchemaError, TableStateError, ToleranceError
from lakespan.sources.options import parse


@pytest.fixture
def b(spark):
    return Bridge(spark)


@pytest.fixture
def at():
    return f"t_{uuid.uuid4().hex[:10]}"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_all_option_faults_together():
    with pytest.raises(OptionError) as e:
        parse({"num_partitions": "0", "truncate": "maybe", "hdfs_url": "x", "merge_key": "a;b", "nonsense": 1})
    assert len(e.value.errors) == 6


def test_modes(spark, b, at):
    df = spark.createDataFrame([(77,)], "col1 int")
    b.write(df, "append", table=at)
    with pytest.raises(TableStateError):
        b.write(df, table=at)
    assert b.write(df, "ignore", table=at)["copied"] == 0
    b.write(df, "overwrite", table=at)
    b.write(df, "append", table=at)
    assert rows(b.read(table=at)) == [(77,), (77,)]
    b.drop(table=at)
    assert not b.exists(table=at)


def test_views_are_not_written(spark, b, at):
    spark.range(1).createOrReplaceTempView(at)
    with pytest.raises(TableStateError):
        b.write(spark.range(1), "append", table=at)


@pytest.mark.parametrize(("tolerance", "passes"), [(0.199, False), (0.5, True)])
def test_tolerance(spark, b, at, tolerance, passes):
    df = spark.createDataFrame([(500,), (-500,), (2**31 - 1,), (-(2**31),), (None,)], "i int")
    o = {"table": at, "target_table_sql": f"CREATE TABLE {at} (i INTEGER NOT NULL)", "failed_rows_percent_tolerance": tolerance}
    if not passes:
        with pytest.raises(ToleranceError):
            b.write(df, "append", **o)
        return
    done = b.write(df, "append", **o)
    assert (done["copied"], done["rejected"], done["failed"]) == (4, 1, 0.2) and b.read(table=at).count() == 4
    assert spark.table(done["rejects"]).count() == 1


def test_an_empty_frame_fails(spark, b, at):
    with pytest.raises(ToleranceError):
        b.write(spark.createDataFrame([], "c boolean"), "append", table=at)


def test_schema_faults(spark, b, at):
    for df in (spark.range(1).select(F.lit(1).alias(" ")), spark.range(1).select(F.create_map(F.lit(1), F.lit(2)).alias("m"), F.lit(1).alias("a")), spark.range(1).select(F.array(F.array("id")).alias("x"))):
        with pytest.raises(SchemaError):
            b.write(df, "append", table=at)


@pytest.mark.parametrize(
    ("columns", "target", "source", "key", "want"),
    [
        ("a int, b int", [(2, 3)] * 2, [(2, 77), (3, 2)], "a", [(2, 77), (2, 77), (3, 2)]),
        ("a int, b int, c int", [(2, 3, 4)] * 2, [(2, 3, 77), (3, 2, 2)], "a, b", [(2, 3, 77), (2, 3, 77), (3, 2, 2)]),
        ("a int, b int, c int", [(2, 3, 4)] * 2, [(2, 3, 5)], "a, b", [(2, 3, 5)] * 2),
        ("a int, b int", [(None, 3)], [(None, 4)], "a", [(None, 3), (None, 4)]),
    ],
)
def test_merge(spark, b, at, columns, target, source, key, want):
    b.write(spark.createDataFrame(target, columns), "append", table=at)
    b.write(spark.createDataFrame(source, columns), "overwrite", table=at, merge_key=key)
    assert rows(b.read(table=at)) == sorted(want, key=str)


def test_merge_keeps_columns_that_are_not_given(spark, b, at):
    b.write(spark.createDataFrame([(2, "hello", 4)] * 2, "a int, b string, c int"), "append", table=at)
    b.write(spark.createDataFrame([(2, "hola"), (3, "world")], "a int, b string"), "append", table=at, merge_key="a")
    assert rows(b.read(table=at)) == [(2, "hola", 4), (2, "hola", 4), (3, "world", None)]
    with pytest.raises(MergeError):
        b.write(spark.createDataFrame([(2, "x"), (2, "y")], "a int, b string"), "append", table=at, merge_key="a")


def test_computed_columns(spark, b, at):
    df = spark.createDataFrame([("Ann", None, "Lee", 30)], "f string, m string, l string, n int")
    sql = f"CREATE TABLE {at} (full_name STRING, age INT, note STRING)"
    b.write(df, "append", table=at, target_table_sql=sql, copy_column_list="a FILLER string, b FILLER string, c FILLER string, age, full_name AS a || ' ' || NVL(b, '-') || ' ' || c")
    assert rows(b.read(table=at)) == [("Ann - Lee", 30, None)]


def test_sets_and_sizes(spark, b, at):
    df = spark.createDataFrame([(1, [1, 1, 2]), (2, [1, 2, 3, 4])], "k int, s array<int>").withMetadata("s", {IS_SET: True})
    done = b.write(df, "append", table=at, array_length=3, failed_rows_percent_tolerance=0.5)
    assert done["rejected"] == 1
    back = b.read(table=at)
    assert rows(back) == [(1, [1, 2])] and back.schema["s"].metadata == {IS_SET: True}


def test_external(spark, b, at, tmp_path):
    df = spark.createDataFrame([(77,)], "col1 int")
    b.write(df, table=at, create_external_table="new-data", staging_fs_url=str(tmp_path / "x"))
    assert rows(b.read(table=at)) == [(77,)]
    with pytest.raises(ExternalTableError):
        b.write(df, table=at + "2", create_external_table="existing-data", staging_fs_url=str(tmp_path / "x"))
    b.write(df.limit(0), table=at + "2", create_external_table="existing-data", staging_fs_url=str(tmp_path / "x"))
    assert rows(b.read(table=at + "2")) == [(77,)]


def test_json_refuses_binary(spark, b, at):
    b.write(spark.createDataFrame([(1, b"x")], "k int, v binary"), "append", table=at)
    with pytest.raises(SchemaError):
        b.read(table=at, json="true")


def test_filters_reach_the_scan(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").where("l_quantity > 45").select("l_orderkey")
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,45.0)" in plan and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_stream_of_upserts(spark, b, at, tmp_path):
    from lakespan.streaming import upsert_batches

    b.write(spark.createDataFrame([(1, "a")], "k long, v string"), "append", table=at)
    spark.createDataFrame([(1, "b"), (2, "c")], "k long, v string").write.parquet(str(tmp_path / "in"))
    q = upsert_batches(spark.readStream.schema("k long, v string").parquet(str(tmp_path / "in")), at, "k").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert rows(b.read(table=at)) == [(1, "b"), (2, "c")]


def left_over(spark):
    return [t.name for t in spark.catalog.listTables() if t.name.startswith(("lakespan_staged_", "lakespan_new_", "lakespan_old_", "lakespan_probe_"))]


def test_a_table_overwritten_by_its_own_rows(spark, b, at):
    b.write(spark.range(10), "append", table=at)
    for truncate in ("false", "true"):
        b.write(b.read(table=at).where("id > 3"), "overwrite", table=at, truncate=truncate)
        assert b.read(table=at).count() == 6
    assert not left_over(spark)


@pytest.mark.parametrize("options", [{}, {"truncate": "true"}, {"target_table_sql": "CREATE TABLE {at} (id BIGINT NOT NULL)"}])
def test_a_failed_overwrite_leaves_the_old_rows(spark, b, at, options):
    b.write(spark.range(3), "append", table=at)
    options = {k: v.format(at=at) for k, v in options.items()}
    with pytest.raises(ToleranceError):  # nothing is copied
        b.write(b.read(table=at).where("id < 0"), "overwrite", table=at, **options)
    with pytest.raises(Exception, match="(?i)divide|division"):
        b.write(b.read(table=at).selectExpr("id / (id - 1) as id"), "overwrite", table=at, **options)
    assert rows(b.read(table=at)) == [(0,), (1,), (2,)] and not left_over(spark)


def test_a_failed_load_keeps_its_rejects_and_no_table(spark, b, at):
    df = spark.createDataFrame([(1,), (None,)], "i int")
    with pytest.raises(ToleranceError) as e:
        b.write(df, "append", table=at, target_table_sql=f"CREATE TABLE {at} (i INT NOT NULL)")
    assert rows(spark.table(e.value.rejects)) == [(None, "null in i")] and not b.exists(table=at) and not left_over(spark)


def test_not_null_in_any_ddl(spark, b, at):
    sql = f"CREATE TABLE {at} (a ARRAY<INT> NOT NULL, `b c` DECIMAL(5, 2) NOT NULL COMMENT 'x, y', c LONG VARCHAR(3))"
    df = spark.createDataFrame([([1], "1.5", "abc"), (None, "1", "a"), ([2], None, "a"), ([3], "3", "abcd")], "a array<int>, b string, c string")
    done = b.write(df.selectExpr("a", "cast(b as decimal(5,2)) as `b c`", "c"), "append", table=at, target_table_sql=sql, failed_rows_percent_tolerance=0.8)
    assert (done["copied"], done["rejected"]) == (1, 3)
    for sql in ("CREATE TABLE other_name (i INT)", "DROP TABLE x", "CREATE TABLE (", f"CREATE TABLE {at}x AS SELECT 1 AS i"):
        with pytest.raises(TableStateError):
            b.write(spark.range(1), "append", table=at + "x", target_table_sql=sql)


def test_truncate_keeps_what_the_table_is(spark, b, at):
    df = spark.createDataFrame([(1, [1, 1]), (2, [2])], "k int, s array<int>").withMetadata("s", {IS_SET: True})
    b.write(df, "append", table=at, array_length=2)
    spark.sql(f"ALTER TABLE {at} SET TBLPROPERTIES ('owner_of_it' = 'a''b')")
    b.write(df, "overwrite", table=at, truncate="true")
    assert b.rules(table=at)["items"] == {"s": 2} and b.rules(table=at)["sets"] == ["s"]
    assert "owner_of_it" in {r["key"] for r in spark.sql(f"SHOW TBLPROPERTIES {at}").collect()}


@pytest.mark.parametrize("name", ['"a b;c"', "t$é", '"x""y.z"', "plain_x41_"])
def test_table_names(spark, b, at, name):
    b.drop(table=name)
    b.write(spark.range(2), "append", table=name)
    assert b.read(table=name).count() == 2 and b.exists(table=name)
    assert name.strip('"').replace('""', '"') in b.tables()
    b.rename(f'"{at} new"', table=name)
    assert not b.exists(table=name) and b.read(table=f'"{at} new"').count() == 2


def test_large_sources_merge_alike(spark, monkeypatch):
    from lakespan.operators import merge as m

    t = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (2, "c", 7), (None, "n", 8)], "k int, `v.w` string, z int")
    s = spark.createDataFrame([(1, "new"), (3, None), (None, "m")], "K int, `v.w` string")
    small = rows(m.merge(t, s, ["k"]))
    monkeypatch.setattr(m, "MOST_SENT", -1)
    assert rows(m.merge(t, s, ["k"])) == small == sorted([(1, "new", 5), (1, "new", 6), (2, "c", 7), (None, "n", 8), (3, None, None), (None, "m", None)], key=str)


def test_sources_are_measured_in_memory(spark, tmp_path):
    """Short keys and repeated texts take far less in files than in a broadcast table, which the driver holds whole."""
    from lakespan.operators import merge as m

    t = spark.range(5, 10).selectExpr("id as k", "'old' as v", "array('old') as a")
    many = spark.range(600_000).selectExpr("id as k")
    spark.range(30_000).selectExpr("id as k", "repeat('x', 2000) as v").write.parquet(str(tmp_path / "long"))
    spark.range(30_000).selectExpr("id as k", "array_repeat('x', 200) as a").write.parquet(str(tmp_path / "nested"))
    few = spark.range(1000).selectExpr("id as k", "'new' as v", "array('new') as a")
    for s, n, sent in ((many, 600_000, False), (spark.read.parquet(str(tmp_path / "long")), 30_000, False), (spark.read.parquet(str(tmp_path / "nested")), 30_000, False), (few, 1000, True)):
        got = m.merge(t, s, ["k"])
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert ("strategy=broadcast" in plan) == sent and "FullOuter" not in plan  # a full join holds all rows of a key in memory
        assert got.count() == n
    assert m.merge(t, few.limit(0), ["k"]).count() == 5


def test_partitioned_folders(spark, b, at, tmp_path):
    folder = str(tmp_path / "it's")
    spark.createDataFrame([(1, "x", 7), (2, "y", 8)], "a int, s string, p int").write.partitionBy("p").parquet(folder)
    for known in ("foo int", ""):
        with pytest.raises(ExternalTableError):
            b.write(spark.createDataFrame([], known or "c int").select(*([] if not known else ["foo"])), table=at, create_external_table="existing-data", staging_fs_url=folder)
    assert not b.exists(table=at) and not left_over(spark)
    b.write(spark.createDataFrame([], "p string"), table=at, create_external_table="existing-data", staging_fs_url=folder)
    assert rows(b.read(table=at)) == [(1, "x", "7"), (2, "y", "8")]
    plan = b.read(table=at).where("p = '7'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_status_of_jobs(spark, b, at):
    b.write(spark.range(1), "append", table=at, save_job_status_table="true")
    with pytest.raises(ToleranceError):
        b.write(spark.range(0), "append", table=at, save_job_status_table="true")
    assert rows(b.job_status().where(F.col("target") == at).select("failed_rows_percent", "success", "phase")) == [(0.0, True, "ended"), (1.0, False, "ended")]


def test_json_guard_and_times(spark, b, at):
    df = spark.sql("select 1 as k, timestamp_ntz'1500-01-01 00:00:00.123456' as t, timestamp'2024-03-31 01:30:00.5Z' as z, map('a', binary('x')) as m")
    with pytest.raises(SchemaError):
        Bridge(spark)._by_json(df, parse({"table": "x", "json": "true"}))
    b.write(df.drop("m"), "append", table=at)
    assert rows(b.read(table=at, json="true")) == rows(df.drop("m"))


def test_reads_prune_columns_nested_ones_and_rows(spark, b, at):
    b.write(spark.range(5).selectExpr("id", "named_struct('a', id, 'b', cast(id as string)) s", "id * 2 as other"), "append", table=at)
    plan = b.read(table=at).where("id > 2").select("s.a")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,s:struct<a:bigint>>" in plan and "GreaterThan(id,2)" in plan


def test_greatest_files(spark, b, at, tmp_path):
    df = spark.range(300_000).selectExpr("id", "id as a", "id as b").coalesce(1)
    b.write(df, table=at, create_external_table="new-data", staging_fs_url=str(tmp_path / "f"), max_file_size_export_mb=1)
    assert len(list((tmp_path / "f").glob("*.parquet"))) > 3


def test_asof_and_range_over_stretches(spark):
    from lakespan.operators.ranges import asof_join, range_join

    left = spark.createDataFrame([(1, 5), (1, 1000), (1, 0), (2, 7), (None, 3)], "k int, at long")
    right = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 999, "c"), (1, 1, "z"), (2, 8, "d"), (None, 1, "n")], "k int, at long, v string")
    for width in (1, 10, 10**6):
        assert rows(asof_join(left, right, "k", "at", width, ["v"])) == sorted([(1, 5, "b"), (1, 1000, "c"), (1, 0, None), (2, 7, None), (None, 3, None)], key=str)
    points, spans = spark.createDataFrame([(1.5,), (-3.0,), (None,)], "x double"), spark.createDataFrame([(1.0, 2.0, "a"), (-3.0, 1.5, "b"), (4.0, 3.0, "c"), (None, 9.0, "d")], "lo double, hi double, n string")
    assert rows(range_join(points, spans, "x", "lo", "hi", 0.7).select("x", "n")) == [(-3.0, "b"), (1.5, "a"), (1.5, "b")]
