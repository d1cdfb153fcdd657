"""Queries that write a table of the catalog and read it back. Each has SQL for the rows that must be in it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakespan.functions import as_set
from lakespan.operators import rejects
from lakespan.plans.reads import query, table
from lakespan.sources.bridge import IS_SET, MAX_LENGTH, Bridge
from lakespan.sources.errors import ToleranceError
from lakespan.streaming import sessions, windowed


def fresh(name: str) -> str:
    return f"lakespan_{name}_{uuid.uuid4().hex[:8]}"


def _folder(spark, name: str) -> str:
    """A new folder beside the warehouse's tables, which all executors see."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{fresh(name)}"


def _written(spark, name: str, *frames: tuple[DataFrame, str], **options) -> DataFrame:
    b, at = Bridge(spark), fresh(name)
    for df, mode in frames:
        b.write(df, mode, table=at, **options)
    return b.read(table=at)


# Save modes and column mapping


@query("SELECT * FROM nation UNION ALL SELECT * FROM nation WHERE n_nationkey < 5")
def write_append(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return _written(spark, "append", (n, "append"), (n.where("n_nationkey < 5"), "append"))


@query("SELECT * FROM nation WHERE n_nationkey < 5")
def write_overwrite(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return _written(spark, "overwrite", (n, "overwrite"), (n.where("n_nationkey < 5"), "overwrite"))


@query("SELECT * FROM nation WHERE n_nationkey >= 5")
def write_truncate(spark, sf_dir):
    """The table's own rows, put back in its place."""
    b, at = Bridge(spark), fresh("truncate")
    b.write(table(spark, sf_dir, "nation"), "overwrite", table=at)
    b.write(b.read(table=at).where("n_nationkey >= 5"), "overwrite", table=at, truncate="true")
    return b.read(table=at)


@query("SELECT * FROM nation")
def write_ignore(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return _written(spark, "ignore", (n, "ignore"), (n.where("n_nationkey < 5"), "ignore"))


@query("SELECT n_nationkey, n_name, CAST(NULL AS INTEGER) AS n_regionkey FROM nation UNION ALL SELECT * FROM nation")
def write_by_name(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return _written(spark, "named", (n, "append"), (n.select(F.col("n_name").alias("N_NAME"), "n_nationkey"), "append"))


@query("SELECT * FROM nation UNION ALL SELECT r_regionkey, r_name, 0 FROM region")
def write_by_position(spark, sf_dir):
    return _written(spark, "placed", (table(spark, sf_dir, "nation"), "append"), (table(spark, sf_dir, "region").withColumn("z", F.lit(0)), "append"))


@query("SELECT * FROM nation UNION ALL SELECT r_regionkey * 2, r_name || '!', NULL FROM region")
def write_column_list(spark, sf_dir):
    """A column list with columns that only serve to compute others."""
    b, at = Bridge(spark), fresh("listed")
    b.write(table(spark, sf_dir, "nation"), "append", table=at)
    b.write(table(spark, sf_dir, "region"), "append", table=at, copy_column_list="k FILLER int, s FILLER string, n_nationkey AS k * 2, n_name AS concat(s, '!')")
    return b.read(table=at)


@query("SELECT CAST(n_nationkey AS BIGINT) AS k, n_name AS s FROM nation")
def write_target_sql(spark, sf_dir):
    b, at = Bridge(spark), fresh("own_sql")
    b.write(table(spark, sf_dir, "nation").selectExpr("n_nationkey as k", "n_name as s"), "append", table=at, target_table_sql=f"CREATE TABLE {at} (k BIGINT NOT NULL, s STRING)")
    return b.read(table=at)


@query("SELECT true AS success, 0.0::DOUBLE AS failed_rows_percent")
def write_job_status(spark, sf_dir):
    b, at = Bridge(spark), fresh("status")
    b.write(table(spark, sf_dir, "region"), "append", table=at, save_job_status_table="true")
    return b.job_status().where(F.col("target") == at).select("success", "failed_rows_percent")


@query("SELECT * FROM lineitem")
def write_lineitem(spark, sf_dir):
    return _written(spark, "lineitem", (table(spark, sf_dir, "lineitem"), "append"))


# Rejected rows

_EVENTS = "(SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value, event_type FROM events)"


def _rejecting(spark, sf_dir):
    b, at = Bridge(spark), fresh("rejects")
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"), "event_type")
    done = b.write(e, "append", table=at, target_table_sql=f"CREATE TABLE {at} (event_id BIGINT, value DOUBLE NOT NULL, event_type STRING)", failed_rows_percent_tolerance=0.99)
    return b.read(table=at), done


@query(f"SELECT * FROM {_EVENTS} WHERE value IS NOT NULL")
def reject_good(spark, sf_dir):
    return _rejecting(spark, sf_dir)[0]


@query(f"SELECT 'null in value' AS rejected_reason, count(*) AS \"count\" FROM {_EVENTS} WHERE value IS NULL HAVING count(*) > 0")
def reject_summary(spark, sf_dir):
    return rejects.summary(spark.table(_rejecting(spark, sf_dir)[1]["rejects"])).select("rejected_reason", "count")


@query("SELECT doc_id, text FROM documents WHERE text IS NULL OR octet_length(encode(text)) <= 2000")
def reject_long_strings(spark, sf_dir):
    """Null texts have no length, so they are taken."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _written(spark, "strlen", (d, "append"), strlen=2000, failed_rows_percent_tolerance=1.0)


@query(f"SELECT 'old' AS what, count(*) AS n FROM region UNION ALL SELECT 'rejected', count(*) FROM {_EVENTS} WHERE value IS NULL")
def reject_failed_load(spark, sf_dir):
    """A load above the tolerance leaves the old rows, and what was rejected can be read."""
    b, at = Bridge(spark), fresh("failing")
    b.write(table(spark, sf_dir, "region").selectExpr("cast(r_regionkey as bigint) as event_id", "cast(r_regionkey as double) as value", "r_name as event_type"), "append", table=at, target_table_sql=f"CREATE TABLE {at} (event_id BIGINT, value DOUBLE NOT NULL, event_type VARCHAR(40))")
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"), "event_type")
    try:
        b.write(e, "overwrite", table=at, truncate="true")
    except ToleranceError as error:
        bad = spark.table(error.rejects)
    return b.read(table=at).agg(F.lit("old").alias("what"), F.count("*").alias("n")).union(bad.agg(F.lit("rejected"), F.count("*")))


# Upserts: finished and partial orders are there, open and partial ones arrive with other values

_OLD = "(SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'O')"
_NEW = "(SELECT o_orderkey, -o_custkey AS o_custkey, 'N' AS o_orderstatus FROM orders WHERE o_orderstatus <> 'F')"


def _merged(spark, sf_dir, source, key="o_orderkey"):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    b, at = Bridge(spark), fresh("merge")
    b.write(o.where("o_orderstatus <> 'O'"), "append", table=at)
    b.write(source(o), "append", table=at, merge_key=key)
    return b.read(table=at)


def _new(o):
    return o.where("o_orderstatus <> 'F'").select("o_orderkey", (-F.col("o_custkey")).alias("o_custkey"), F.lit("N").alias("o_orderstatus"))


@query(f"SELECT * FROM {_NEW} UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def merge_upsert(spark, sf_dir):
    return _merged(spark, sf_dir, _new)


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def merge_insert_only(spark, sf_dir):
    return _merged(spark, sf_dir, lambda o: o.where("o_orderstatus = 'O'"))


@query(f"SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(b.o_custkey, a.o_custkey) AS o_custkey, a.o_orderstatus FROM {_OLD} a FULL JOIN {_NEW} b ON a.o_orderkey = b.o_orderkey")
def merge_partial_columns(spark, sf_dir):
    return _merged(spark, sf_dir, lambda o: _new(o).drop("o_orderstatus"))


@query(f"SELECT * FROM {_OLD} WHERE o_orderstatus = 'F' OR o_custkey <> 0 UNION ALL SELECT * FROM {_NEW}")
def merge_two_keys(spark, sf_dir):
    """No pair of keys is there but those of customer 0, as the customers of the new rows are negative."""
    return _merged(spark, sf_dir, _new, "o_orderkey, o_custkey")


@query("SELECT n_nationkey AS \"k.1\", CASE WHEN n_nationkey < 5 THEN 'new' ELSE n_name END AS \"a \"\"b` c\", n_regionkey AS \"check\" FROM nation")
def merge_special_names(spark, sf_dir):
    """Dots, quotes, blanks, back-ticks and reserved words in names of columns, and a table's name with them."""
    b, at = Bridge(spark), f'"{fresh("odd")};$ té.x"'
    n = table(spark, sf_dir, "nation").toDF("k.1", 'a "b` c', "check")
    b.write(n, "append", table=at)
    b.write(n.where("check >= 0 and `k.1` < 5").withColumn('a "b` c', F.lit("new")), "append", table=at, merge_key='"k.1"')
    return b.read(table=at)


@query("SELECT * FROM nation WHERE n_regionkey = 1")
def overwrite_self(spark, sf_dir):
    """A table overwritten by its own rows, without truncate."""
    b, at = Bridge(spark), fresh("self")
    b.write(table(spark, sf_dir, "nation"), "overwrite", table=at)
    b.write(b.read(table=at).where("n_regionkey = 1"), "overwrite", table=at)
    return b.read(table=at)


@query("SELECT n_name AS s, n_nationkey::BIGINT AS k, 7 AS d FROM nation")
def write_defaults(spark, sf_dir):
    """Columns that the rows lack take their default; a second statement and PARTITION BY are left out."""
    b, at = Bridge(spark), fresh("defaults")
    sql = f"CREATE TABLE {at} (s VARCHAR(50) NOT NULL, k BIGINT, d INT DEFAULT 7) PARTITION BY EXTRACT(year FROM k); CREATE PROJECTION p AS SELECT * FROM {at}"
    b.write(table(spark, sf_dir, "nation").selectExpr("n_nationkey as k", "n_name as s"), "append", table=at, target_table_sql=sql)
    return b.read(table=at)


# External tables, JSON, nested types


@query("SELECT * FROM supplier")
def external_new(spark, sf_dir):
    b, at = Bridge(spark), fresh("ext")
    b.write(table(spark, sf_dir, "supplier"), table=at, create_external_table="new-data", staging_fs_url=_folder(spark, "ext"))
    return b.read(table=at)


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey = 3")
def external_existing(spark, sf_dir):
    b, at = Bridge(spark), fresh("ext")
    d = table(spark, sf_dir, "supplier")
    b.write(d.limit(0), table=at, create_external_table="existing-data", staging_fs_url=f"{sf_dir}/supplier.parquet")
    return b.read(table=at).where("s_nationkey = 3").select("s_suppkey", "s_name")


@query("SELECT s_suppkey, s_nationkey::BIGINT AS s_nationkey FROM supplier WHERE s_nationkey < 20")
def external_partitioned(spark, sf_dir):
    """Files tell their own columns' types; the empty frame tells that of the partition column."""
    b, at, folder = Bridge(spark), fresh("ext"), _folder(spark, "parts")
    table(spark, sf_dir, "supplier").repartition("s_nationkey").write.partitionBy("s_nationkey").parquet(folder)
    b.write(spark.createDataFrame([], "s_nationkey long"), table=at, create_external_table="existing-data", staging_fs_url=folder)
    return b.read(table=at).where("s_nationkey < 20").select("s_suppkey", "s_nationkey")


@query("SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT 1000000 + s_suppkey, 'short' FROM supplier WHERE s_suppkey < 10")
def external_maxlength(spark, sf_dir):
    """maxlength of the empty frame's column bounds later writes."""
    b, at, folder = Bridge(spark), fresh("ext"), _folder(spark, "sized")
    d = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    d.write.parquet(folder)
    b.write(d.limit(0).withMetadata("s_name", {MAX_LENGTH: 18}), table=at, create_external_table="existing-data", staging_fs_url=folder)
    more = d.where("s_suppkey < 20").select(F.col("s_suppkey") + 1_000_000, F.when(F.col("s_suppkey") < 10, "short").otherwise("x" * 19).alias("s_name"))
    b.write(more.toDF("s_suppkey", "s_name"), "append", table=at, failed_rows_percent_tolerance=0.9)
    return b.read(table=at)


@query("SELECT event_id, ts, value, event_type AS kind, [event_type] AS a FROM events")
def json_scan(spark, sf_dir):
    """A table read by way of JSON files."""
    b, at = Bridge(spark), fresh("json")
    e = table(spark, sf_dir, "events").select("event_id", "ts", "value", F.struct("event_type", F.array("event_type").alias("a")).alias("s"))
    b.write(e, "append", table=at)
    return b.read(table=at, json="true").selectExpr("event_id", "ts", "value", "s.event_type as kind", "s.a")


# Types


def _typed(spark, sf_dir, of, name, *exprs):
    return _written(spark, name, (table(spark, sf_dir, of).selectExpr(*exprs), "append"))


@query("SELECT l_orderkey AS k, l_linenumber AS l, l_linenumber::TINYINT AS b, (l_linenumber * -100)::SMALLINT AS s, (l_orderkey - 9223372036854775807) AS long, l_quantity::FLOAT AS f, l_tax AS d, l_linenumber > 3 AS t FROM lineitem")
def types_numbers(spark, sf_dir):
    return _typed(spark, sf_dir, "lineitem", "numbers", "l_orderkey k", "l_linenumber l", "cast(l_linenumber as tinyint) b", "cast(l_linenumber * -100 as smallint) s", "l_orderkey - 9223372036854775807 as long", "cast(l_quantity as float) f", "l_tax d", "l_linenumber > 3 t")


@query("SELECT o_orderkey AS k, CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS VARCHAR) AS a, CAST(CAST(o_totalprice AS DECIMAL(38, 4)) * -1 AS VARCHAR) AS b FROM orders")
def types_decimals(spark, sf_dir):
    return _typed(spark, sf_dir, "orders", "decimals", "o_orderkey k", "cast(o_totalprice as decimal(15, 2)) a", "cast(-o_totalprice as decimal(38, 4)) b").selectExpr("k", "cast(a as string) a", "cast(b as string) b")


@query("SELECT doc_id, hex(encode(text)) AS h, octet_length(encode(text)) AS n FROM documents")
def types_binary(spark, sf_dir):
    return _typed(spark, sf_dir, "documents", "binary", "doc_id", "cast(text as binary) b").selectExpr("doc_id", "hex(b) h", "cast(octet_length(b) as bigint) n")


@query("SELECT o_orderkey AS k, (o_orderdate::DATE - INTERVAL 600 YEAR)::DATE AS d, o_orderdate - INTERVAL 500 YEAR AS t FROM orders")
def types_old_dates(spark, sf_dir):
    """Days and times before 1582, by one calendar throughout."""
    return _typed(spark, sf_dir, "orders", "old", "o_orderkey k", "cast(o_orderdate as date) - interval 600 year as d", "o_orderdate - interval 500 year as t")


@query("SELECT event_id, '0 ' || lpad((event_id % 24)::VARCHAR, 2, '0') || ':00:00' AS span, printf('%d-%d', event_id // 12, event_id % 12) AS months FROM events")
def types_intervals(spark, sf_dir):
    """Intervals become text where they are read for stores without them."""
    e = _typed(spark, sf_dir, "events", "intervals", "event_id", "make_dt_interval(0, cast(event_id % 24 as int)) a", "make_ym_interval(0, cast(event_id as int)) b")
    return e.select("event_id", F.regexp_extract(F.col("a").cast("string"), "'(.*)'", 1).alias("span"), F.regexp_extract(F.col("b").cast("string"), "'(.*)'", 1).alias("months"))


@query("SELECT c_custkey, c_name AS a, [c_acctbal, NULL] AS b, c_nationkey AS c, [[c_nationkey], []] AS d FROM customer")
def types_nested(spark, sf_dir):
    c = _typed(spark, sf_dir, "customer", "nested", "c_custkey", "named_struct('a b', c_name, 'in', array(named_struct('x', array(c_acctbal, null), 'y', c_nationkey))) s", "array(array(c_nationkey), array()) d")
    return c.selectExpr("c_custkey", "s.`a b` a", "s.`in`[0].x b", "s.`in`.y[0] c", "d")


# Streams


def _events_stream(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def _run(spark, stream, name, mode):
    at = fresh(name)
    stream.writeStream.outputMode(mode).option("checkpointLocation", _folder(spark, "progress")).trigger(availableNow=True).toTable(at).awaitTermination()
    return spark.table(at)


#: The watermark closes windows that end a quarter of an hour before the last event.
_CLOSED = "(SELECT max(ts) - INTERVAL 15 MINUTE FROM events)"


@query(f"SELECT start, event_type, n, hi FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, max(value) AS hi FROM events GROUP BY ALL) WHERE start + INTERVAL 1 HOUR <= {_CLOSED}")
def stream_tumbling(spark, sf_dir):
    out = windowed(_events_stream(spark, sf_dir), "ts", "15 minutes", "1 hour", ["event_type"], {"n": F.count("*"), "hi": F.max("value")})
    return _run(spark, out, "tumbling", "append").withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(f"SELECT start, count(*) AS n FROM (SELECT time_bucket(INTERVAL 30 MINUTE, ts) - to_minutes(CAST(30 * i AS BIGINT)) AS start FROM events, range(2) r(i)) GROUP BY ALL HAVING start + INTERVAL 1 HOUR <= {_CLOSED}")
def stream_sliding(spark, sf_dir):
    out = windowed(_events_stream(spark, sf_dir), "ts", "15 minutes", "1 hour", [], {"n": F.count("*")}, slide="30 minutes")
    return _run(spark, out, "sliding", "append").withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(
    f"""SELECT min(ts) AS start, user_id, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
    SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 8 HOUR THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s
    HAVING max(ts) + INTERVAL 8 HOUR <= {_CLOSED}"""
)
def stream_sessions(spark, sf_dir):
    out = sessions(_events_stream(spark, sf_dir), "ts", "15 minutes", "8 hours", ["user_id"])
    return _run(spark, out, "sessions", "append").withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("SELECT vec_id, embedding[1] AS first, len(embedding) AS n FROM embeddings")
def array_roundtrip(spark, sf_dir):
    return _written(spark, "array", (table(spark, sf_dir, "embeddings"), "append")).selectExpr("vec_id", "embedding[0] as first", "cast(size(embedding) as bigint) as n")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def struct_roundtrip(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.struct("c_name", F.struct("c_acctbal").alias("in")).alias("s"))
    return _written(spark, "struct", (c, "append")).selectExpr("c_custkey", "s.c_name", "s.`in`.c_acctbal")


@query("SELECT o_custkey, count(DISTINCT o_orderpriority) AS n, min(o_orderpriority) AS lo FROM orders GROUP BY ALL")
def set_roundtrip(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderpriority").alias("p")).withMetadata("p", {IS_SET: True})
    return _written(spark, "set", (o, "append")).select("o_custkey", F.size("p").cast("long").alias("n"), as_set("p")[0].alias("lo"))


@query("SELECT n_nationkey AS k, n_regionkey AS v FROM nation")
def map_external(spark, sf_dir):
    b, at = Bridge(spark), fresh("map")
    n = table(spark, sf_dir, "nation").select("n_name", F.create_map("n_nationkey", "n_regionkey").alias("m"))
    b.write(n, table=at, create_external_table="new-data", staging_fs_url=_folder(spark, "map"))
    return b.read(table=at).select(F.explode("m").alias("k", "v"))


@query("SELECT " + ", ".join(f"n_name || '_{i}' AS c{i}" for i in range(1600)) + " FROM nation")
def wide_1600_columns(spark, sf_dir):
    n = table(spark, sf_dir, "nation").selectExpr(*[f"concat(n_name, '_{i}') AS c{i}" for i in range(1600)])
    return _written(spark, "wide", (n, "append"))


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def query_option_dbschema(spark, sf_dir):
    """Unqualified names in a query are those of dbschema."""
    b, db = Bridge(spark), "lakespan_schema"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for x in ("nation", "region"):
        b.drop(dbschema=db, table=f"own_{x}")
        b.write(spark.read.parquet(f"{sf_dir}/{x}.parquet").limit(0), dbschema=db, table=f"own_{x}", create_external_table="existing-data", staging_fs_url=f"{sf_dir}/{x}.parquet")
    return b.read(dbschema=db, query="SELECT n_name, r_name FROM own_nation JOIN own_region ON n_regionkey = r_regionkey;")
