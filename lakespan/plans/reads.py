"""Queries that read: scans, projections, filters, aggregates, joins, sorts, SQL texts. Each has SQL for the same rows."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakespan.functions import Words, predicates, soundex_distance
from lakespan.operators.percentiles import percentiles
from lakespan.operators.ranges import asof_join, micros, range_join
from lakespan.sources.bridge import Bridge

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table over the given files, read through the bridge; it is registered when it is first asked for."""
    b, at = Bridge(spark), f"lakespan_src_{name}_{zlib.crc32(sf_dir.encode()):08x}"
    if not b.exists(table=at):
        b.write(spark.createDataFrame([], "c int").drop("c"), table=at, create_external_table="existing-data", staging_fs_url=f"{sf_dir}/{name}.parquet")
    return b.read(table=at)


def query(sql: str | None = None, name: str | None = None):
    """Register a function of (spark, sf_dir) as a query."""

    def put(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE_SQL[name or f.__name__] = sql
        return f

    return put


def on(of: str, name: str, sql: str, f) -> None:
    """Register f, a function of one table's DataFrame, as a query."""
    query(sql, name)(lambda spark, sf_dir: f(table(spark, sf_dir, of)))


# Scans and projections

on("lineitem", "scan_table", "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL",
   lambda d: d.where("l_shipdate <= timestamp_ntz'1998-09-02'").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty")))
on("nation", "scan_all", "SELECT * FROM nation", lambda d: d.select("*"))
on("lineitem", "scan_prune", "SELECT l_orderkey, l_quantity FROM lineitem", lambda d: d.select("l_orderkey", "l_quantity"))
on("nation", "scan_drop_cols", "SELECT n_nationkey, n_name FROM nation", lambda d: d.drop("n_regionkey"))
on("lineitem", "scan_empty", "SELECT l_orderkey FROM lineitem WHERE l_orderkey < 0", lambda d: d.where("l_orderkey < 0").select("l_orderkey"))
on("nation", "special_column_names", 'SELECT n_nationkey AS "check", n_name AS "a""b c" FROM nation', lambda d: d.select(F.col("n_nationkey").alias("check"), F.col("n_name").alias('a"b c')))
on("orders", "cast_columns", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust, CAST(o_orderdate AS DATE) AS day FROM orders",
   lambda d: d.select("o_orderkey", F.col("o_custkey").cast("string").alias("cust"), F.col("o_orderdate").cast("date").alias("day")))

# The twelve shapes of filters, alone, and all pairs of them under and, or and not

_PART = "(SELECT p_partkey, p_size, CASE WHEN p_type <> 'STANDARD' THEN p_type END AS p_type FROM part)"
_SHAPES = {
    "eq": "p_size = 3", "gt": "p_size > 5", "ge": "p_size >= 5", "lt": "p_size < 4", "le": "p_size <= 4", "in": "p_size IN (1, 2, 7)", "is_null": "p_type IS NULL", "is_not_null": "p_type IS NOT NULL",
    "not": "NOT (p_size = 3)", "starts": "starts_with(p_type, 'L')", "ends": "suffix(p_type, 'E')", "contains": "contains(p_type, 'I')",
}


def _part(d: DataFrame) -> DataFrame:
    return d.select("p_partkey", "p_size", F.when(F.col("p_type") != "STANDARD", F.col("p_type")).alias("p_type"))


for _name, _sql in _SHAPES.items():
    on("part", f"filter_{_name}", f"SELECT * FROM {_PART} WHERE {_sql}", lambda d, k=_name: _part(d).where(predicates("p_size", "p_type")[k]))


def _pairs(d: DataFrame) -> DataFrame:
    p = predicates("p_size", "p_type")
    counts = [F.count(F.when(c, 1)).alias(f"{how}_{a}_{b}") for a in p for b in p for how, c in (("and", p[a] & p[b]), ("or", p[a] | p[b]), ("not", ~((p[a] & p[b]) | (p[b] & p[a]))))]
    return _part(d).agg(*counts)


_PAIRS = ", ".join(
    f'count(CASE WHEN {c} THEN 1 END) AS "{how}_{a}_{b}"'
    for a, x in _SHAPES.items()
    for b, y in _SHAPES.items()
    for how, c in (("and", f"{x} AND {y}"), ("or", f"{x} OR {y}"), ("not", f"NOT (({x} AND {y}) OR ({y} AND {x}))"))
)
on("part", "filter_pairs", f"SELECT {_PAIRS} FROM {_PART}", _pairs)
on("lineitem", "filter_and", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_discount < 0.02", lambda d: d.where((F.col("l_quantity") > 45) & (F.col("l_discount") < 0.02)).select("l_orderkey", "l_quantity"))
on("documents", "filter_wildcard_literal", "SELECT doc_id FROM documents WHERE contains(text, '_') OR contains(text, '%')", lambda d: d.where(F.col("text").contains("_") | F.col("text").contains("%")).select("doc_id"))
on("customer", "filter_quote_literal", "SELECT * FROM (SELECT c_custkey, replace(c_name, '#', chr(39)) AS who FROM customer) WHERE contains(who, chr(39) || '0000') AND who <> 'it'",
   lambda d: d.select("c_custkey", F.replace("c_name", F.lit("#"), F.lit("'")).alias("who")).where(F.col("who").contains("'0000") & (F.col("who") != "it's")))
on("part", "filter_null_safe", f"SELECT p_partkey FROM {_PART} WHERE p_type IS NOT DISTINCT FROM NULL", lambda d: _part(d).where(F.col("p_type").eqNullSafe(F.lit(None))).select("p_partkey"))
on("part", "filter_in_with_null", f"SELECT p_partkey FROM {_PART} WHERE p_type IN ('ECONOMY', NULL)", lambda d: _part(d).where("p_type in ('ECONOMY', null)").select("p_partkey"))
on("orders", "filter_date", "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-10-03'",
   lambda d: d.where((F.col("o_orderdate") >= F.lit("1998-10-03").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit("1998-10-04").cast("timestamp_ntz"))).select("o_orderkey"))
on("events", "filter_timestamp", "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-05 12:00:00.123456'", lambda d: d.where(F.col("ts") > F.lit("2024-01-05 12:00:00.123456").cast("timestamp_ntz")).select("event_id"))
on("part", "filter_like", "SELECT p_partkey FROM part WHERE p_name LIKE '%d_w%'", lambda d: d.where(F.col("p_name").like("%d_w%")).select("p_partkey"))

# Aggregates

on("lineitem", "agg_all", "SELECT count(*) AS n, count(l_tax) AS n_tax, round(sum(l_quantity), 2) AS s, min(l_shipdate) AS lo, max(l_extendedprice) AS hi, round(avg(l_discount), 6) AS mean FROM lineitem",
   lambda d: d.agg(F.count("*").alias("n"), F.count("l_tax").alias("n_tax"), F.round(F.sum("l_quantity"), 2).alias("s"), F.min("l_shipdate").alias("lo"), F.max("l_extendedprice").alias("hi"), F.round(F.avg("l_discount"), 6).alias("mean")))
on("lineitem", "agg_group_by", "SELECT l_suppkey, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS s, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY ALL",
   lambda d: d.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("s"), F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi")))
on("lineitem", "agg_filter_group_by", "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity > 40 GROUP BY ALL", lambda d: d.where("l_quantity > 40").groupBy("l_returnflag").agg(F.count("*").alias("n")))
on("part", "agg_null_key", f"SELECT p_type, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS s FROM {_PART} GROUP BY ALL", lambda d: _part(d).groupBy("p_type").agg(F.count("*").alias("n"), F.sum("p_size").alias("s")))
on("lineitem", "agg_empty", "SELECT count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS s FROM lineitem WHERE l_orderkey < 0", lambda d: d.where("l_orderkey < 0").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("s")))
on("customer", "distinct_rows", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer", lambda d: d.select("c_nationkey", "c_mktsegment").distinct())
on("customer", "count_distinct", "SELECT c_nationkey, count(DISTINCT c_mktsegment) AS n FROM customer GROUP BY ALL", lambda d: d.groupBy("c_nationkey").agg(F.countDistinct("c_mktsegment").alias("n")))
on("orders", "sort_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10", lambda d: d.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10))
on("orders", "sort_rank", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) AS r FROM orders",
   lambda d: d.selectExpr("o_orderkey", "row_number() over (partition by o_orderpriority order by o_totalprice, o_orderkey) as r"))
on("orders", "agg_rollup", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)", lambda d: d.rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n")))
on("lineitem", "regression", "SELECT round(regr_slope(l_extendedprice, l_quantity), 2) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem",
   lambda d: d.agg(F.round(F.regr_slope("l_extendedprice", "l_quantity"), 2).alias("slope"), F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 2).alias("intercept")))

_CUBE = "o_orderstatus, o_orderpriority"
on("orders", "agg_cube", f"SELECT {_CUBE}, grouping_id({_CUBE}) AS g, count(*) AS n FROM orders GROUP BY CUBE ({_CUBE})", lambda d: d.cube("o_orderstatus", "o_orderpriority").agg(F.grouping_id().alias("g"), F.count("*").alias("n")))
on("orders", "agg_grouping_sets", f"SELECT {_CUBE}, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())",
   lambda d: d.groupingSets([["o_orderstatus"], ["o_orderpriority"], []], "o_orderstatus", "o_orderpriority").agg(F.round(F.sum("o_totalprice"), 2).alias("total")))
on("lineitem", "agg_having", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 40 AND max(l_quantity) >= 50", lambda d: d.groupBy("l_partkey").agg(F.count("*").alias("n"), F.max("l_quantity").alias("hi")).where("n > 40 and hi >= 50").drop("hi"))
on("lineitem", "agg_percentiles", "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS mid, round(quantile_cont(l_extendedprice, 0.9), 4) AS high, round(stddev_samp(l_discount), 8) AS sd, round(corr(l_quantity, l_extendedprice), 8) AS r FROM lineitem GROUP BY ALL",
   lambda d: percentiles(d, "l_returnflag", "l_extendedprice", {"mid": 0.5, "high": 0.9}, F.round(F.stddev_samp("l_discount"), 8).alias("sd"), F.round(F.corr("l_quantity", "l_extendedprice"), 8).alias("r"))
   .withColumns({c: F.round(c, 4) for c in ("mid", "high")}))
on("orders", "agg_lists", "SELECT o_orderpriority, array_to_string(list_sort(list(DISTINCT o_orderstatus)), '') AS kinds, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS top FROM orders GROUP BY ALL",
   lambda d: d.groupBy("o_orderpriority").agg(F.array_join(F.array_sort(F.collect_set("o_orderstatus")), "").alias("kinds"), F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("top")))
on("events", "agg_pivot", "SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'view') AS view FROM events GROUP BY ALL",
   lambda d: d.groupBy("user_id").pivot("event_type", ["click", "view"]).agg(F.count("event_id")).fillna(0))

# Windows

on("events", "window_rank", "SELECT event_id, rank() OVER w AS r, dense_rank() OVER w AS d, ntile(4) OVER (PARTITION BY event_type ORDER BY value, event_id) AS q, round(percent_rank() OVER w, 8) AS p FROM events WINDOW w AS (PARTITION BY event_type ORDER BY value)",
   lambda d: d.withColumns({
       "r": F.expr("rank() over (partition by event_type order by value)"), "d": F.expr("dense_rank() over (partition by event_type order by value)"),
       "q": F.expr("ntile(4) over (partition by event_type order by value, event_id)"), "p": F.expr("round(percent_rank() over (partition by event_type order by value), 8)"),
   }).select("event_id", *(F.col(c).cast("long").alias(c) for c in "rdq"), "p"))
on("events", "window_frames", "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS hi, lag(event_id, 1) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before, first_value(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS first FROM events",
   lambda d: d.selectExpr("event_id", "count(*) over (partition by user_id order by ts, event_id rows between 2 preceding and current row) as n", "max(value) over (partition by user_id order by ts, event_id rows between 2 preceding and 1 following) as hi",
                          "lag(event_id, 1) over (partition by user_id order by ts, event_id) as before", "first_value(event_id) over (partition by user_id order by ts, event_id) as first"))
on("events", "window_range", "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS n FROM events",
   lambda d: d.selectExpr("event_id", "count(*) over (partition by user_id order by ts range between interval 1 day preceding and current row) as n"))
on("events", "window_tumbling", "SELECT time_bucket(INTERVAL 6 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
   lambda d: d.groupBy(F.window("ts", "6 hours"), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "event_type", "n"))

# Scalar functions

on("part", "func_strings", "SELECT p_partkey, upper(p_name) AS u, length(p_name) AS n, substr(p_name, 2, 4) AS s, replace(p_brand, 'Brand', 'B') AS r, lpad(p_type, 10, '*') AS l, reverse(p_type) AS v, split_part(p_name, ' ', 1) AS w, regexp_replace(p_name, '[aeiou]+', '-', 'g') AS x, concat_ws('|', p_brand, p_type) AS c, instr(p_name, 'a') AS i FROM part",
   lambda d: d.selectExpr("p_partkey", "upper(p_name) u", "cast(length(p_name) as bigint) n", "substr(p_name, 2, 4) s", "replace(p_brand, 'Brand', 'B') r", "lpad(p_type, 10, '*') l", "reverse(p_type) v", "split_part(p_name, ' ', 1) w",
                          "regexp_replace(p_name, '[aeiou]+', '-') x", "concat_ws('|', p_brand, p_type) c", "cast(instr(p_name, 'a') as bigint) i"))
on("orders", "func_dates", "SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, dayofweek(o_orderdate) AS w, date_trunc('month', o_orderdate)::DATE AS t, last_day(o_orderdate) AS e, date_diff('day', DATE '1995-01-01', o_orderdate::DATE) AS n, (o_orderdate::DATE + INTERVAL 1 MONTH)::DATE AS a, strftime(o_orderdate, '%Y/%m/%d') AS f FROM orders",
   lambda d: d.selectExpr("o_orderkey", "cast(year(o_orderdate) as bigint) y", "cast(month(o_orderdate) as bigint) m", "cast(dayofweek(o_orderdate) - 1 as bigint) w", "cast(trunc(o_orderdate, 'month') as date) t", "last_day(o_orderdate) e",
                          "cast(datediff(o_orderdate, date'1995-01-01') as bigint) n", "add_months(o_orderdate, 1) a", "date_format(o_orderdate, 'yyyy/MM/dd') f"))
on("lineitem", "func_math", "SELECT l_orderkey, l_linenumber, round(sqrt(l_extendedprice), 6) AS s, round(ln(l_quantity), 8) AS l, round(pow(l_discount, 2), 8) AS p, floor(l_extendedprice)::BIGINT AS f, ceil(l_extendedprice)::BIGINT AS c, abs(l_tax - 0.05) AS a, l_orderkey % 7 AS m, greatest(l_tax, l_discount) AS g, sign(l_quantity - 25)::BIGINT AS i FROM lineitem",
   lambda d: d.selectExpr("l_orderkey", "l_linenumber", "round(sqrt(l_extendedprice), 6) s", "round(ln(l_quantity), 8) l", "round(pow(l_discount, 2), 8) p", "cast(floor(l_extendedprice) as bigint) f", "cast(ceil(l_extendedprice) as bigint) c",
                          "abs(l_tax - 0.05D) a", "l_orderkey % 7 m", "greatest(l_tax, l_discount) g", "cast(sign(l_quantity - 25) as bigint) i"))
on("embeddings", "func_arrays", "SELECT vec_id, len(embedding) AS n, round(list_max(embedding), 5) AS hi, len(list_filter(embedding, lambda x: x > 0)) AS pos, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 4) AS sq, list_contains(list_slice(embedding, 1, 2), embedding[1]) AS has FROM embeddings",
   lambda d: d.selectExpr("vec_id", "cast(size(embedding) as bigint) n", "round(array_max(embedding), 5) hi", "cast(size(filter(embedding, x -> x > 0)) as bigint) pos", "round(aggregate(embedding, 0D, (a, x) -> a + cast(x as double) * cast(x as double)), 4) sq", "array_contains(slice(embedding, 1, 2), embedding[0]) has"))
on("events", "func_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.none') AS none FROM events", lambda d: d.select("event_id", F.from_json("props", "k bigint, none string").alias("j")).select("event_id", "j.k", "j.none"))
on("customer", "func_conditional", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'owes' WHEN c_acctbal < 5000 THEN 'some' ELSE 'much' END AS kind, nullif(c_mktsegment, 'BUILDING') AS seg, coalesce(nullif(c_mktsegment, 'BUILDING'), '-') AS known, try_cast(substr(c_name, 10) AS BIGINT) AS num FROM customer",
   lambda d: d.select("c_custkey", F.when(F.col("c_acctbal") < 0, "owes").when(F.col("c_acctbal") < 5000, "some").otherwise("much").alias("kind"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"), F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("-")).alias("known"), F.expr("try_cast(substr(c_name, 10) as bigint)").alias("num")))
on("supplier", "func_hashes", "SELECT s_suppkey, md5(s_name) AS m, sha256(s_name) AS s, to_base64(encode(s_name)) AS b, hex(encode(s_name)) AS h FROM supplier",
   lambda d: d.select("s_suppkey", F.md5(F.col("s_name").cast("binary")).alias("m"), F.sha2("s_name", 256).alias("s"), F.base64(F.col("s_name").cast("binary")).alias("b"), F.hex("s_name").alias("h")))

# Functions in Python


@query("SELECT n_nationkey AS a, r_regionkey AS b, 0 AS n FROM nation JOIN region ON n_regionkey = r_regionkey")
def udf_vectorised(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select(F.col("n_nationkey").alias("a"), F.col("r_regionkey").alias("b"), soundex_distance("n_name", "n_name").alias("n"))


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word, unnest(range(len(string_split(p_name, ' '))))::INT AS place FROM part")
def udtf_words(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return p.lateralJoin(Words(F.col("p_name").outer())).select("p_partkey", "word", "place")


# Joins


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def join_inner(spark, sf_dir):
    return table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


@query("SELECT a.n_name AS a_name, b.n_name AS b_name FROM nation a JOIN nation b ON a.n_nationkey = b.n_regionkey")
def join_self(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.alias("a").join(n.alias("b"), F.col("a.n_nationkey") == F.col("b.n_regionkey")).select(F.col("a.n_name").alias("a_name"), F.col("b.n_name").alias("b_name"))


@query("SELECT n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def join_triple(spark, sf_dir):
    o, c, n = (table(spark, sf_dir, x) for x in ("orders", "customer", "nation"))
    rows = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return rows.groupBy("n_name").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def _customers(how):
    def run(spark, sf_dir):
        c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").where("o_totalprice > 400000")
        rows = c.join(o, c.c_custkey == o.o_custkey, how)
        return rows.select("c_custkey", "o_orderkey") if how in ("left", "full") else rows.select("c_custkey")

    return run


_BIG = "(SELECT * FROM orders WHERE o_totalprice > 400000)"
query(f"SELECT c_custkey, o_orderkey FROM customer LEFT JOIN {_BIG} ON c_custkey = o_custkey", "join_left")(_customers("left"))
query(f"SELECT c_custkey, o_orderkey FROM customer FULL JOIN {_BIG} ON c_custkey = o_custkey", "join_full")(_customers("full"))
query(f"SELECT c_custkey, o_orderkey FROM {_BIG} RIGHT JOIN customer ON c_custkey = o_custkey", "join_right")(
    lambda spark, sf_dir: table(spark, sf_dir, "orders").where("o_totalprice > 400000").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "right").select("c_custkey", "o_orderkey")
)
query(f"SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM {_BIG})", "join_semi")(_customers("left_semi"))
query(f"SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM {_BIG})", "join_anti")(_customers("left_anti"))


@query("SELECT e.event_id, p.event_id AS last_click FROM events e LEFT JOIN LATERAL (SELECT arg_max(c.event_id, (c.ts, c.event_id)) AS event_id FROM events c WHERE c.event_type = 'click' AND c.user_id = e.user_id AND c.ts <= e.ts) p ON true WHERE e.event_type = 'purchase'")
def join_asof(spark, sf_dir):
    """Each purchase with the user's last click before it."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", micros("ts").alias("at"), "event_type")
    clicks = e.where("event_type = 'click'").select("user_id", "at", F.col("event_id").alias("last_click"))
    return asof_join(e.where("event_type = 'purchase'"), clicks, "user_id", "at", 4e11, ["last_click"]).select("event_id", "last_click")


@query("SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_acctbal BETWEEN s_acctbal - 2.5 AND s_acctbal + 2.5")
def join_range(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_acctbal") - 2.5).alias("lo"), (F.col("s_acctbal") + 2.5).alias("hi"))
    return range_join(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), s, "c_acctbal", "lo", "hi", 5.0).select("c_custkey", "s_suppkey")


@query("SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_acctbal < b.s_acctbal")
def join_theta(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    a, b = s.alias("a"), s.alias("b")
    return a.join(b, (F.col("a.s_nationkey") == F.col("b.s_nationkey")) & (F.col("a.s_acctbal") < F.col("b.s_acctbal"))).select(F.col("a.s_suppkey").alias("a"), F.col("b.s_suppkey").alias("b"))


@query("SELECT n_nationkey, o_orderkey FROM nation, LATERAL (SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = n_nationkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 3)")
def join_lateral(spark, sf_dir):
    """The three dearest orders of each nation: a window's rank, as no join is needed for it."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    top = o.withColumn("r", F.expr("row_number() over (partition by c_nationkey order by o_totalprice desc, o_orderkey)")).where("r <= 3")
    return table(spark, sf_dir, "nation").join(top, F.col("n_nationkey") == F.col("c_nationkey")).select("n_nationkey", "o_orderkey")


_A, _B = "SELECT c_custkey AS k FROM customer WHERE c_acctbal > 1000", "SELECT o_custkey AS k FROM orders WHERE o_totalprice > 300000"


def _sets(f):
    def run(spark, sf_dir):
        a = table(spark, sf_dir, "customer").where("c_acctbal > 1000").selectExpr("c_custkey as k")
        return f(a, table(spark, sf_dir, "orders").where("o_totalprice > 300000").selectExpr("o_custkey as k"))

    return run


query(f"{_A} EXCEPT {_B}", "set_except")(_sets(lambda a, b: a.subtract(b)))
query(f"{_A} EXCEPT ALL {_B}", "set_except_all")(_sets(lambda a, b: a.exceptAll(b)))
query(f"{_A} INTERSECT {_B}", "set_intersect")(_sets(lambda a, b: a.intersect(b)))
query(f"{_A} INTERSECT ALL {_B}", "set_intersect_all")(_sets(lambda a, b: a.intersectAll(b)))
query(f"{_A} UNION ALL {_B}", "set_union_all")(_sets(lambda a, b: a.union(b)))
query(f"{_A} UNION {_B}", "set_union")(_sets(lambda a, b: a.union(b).distinct()))

# SQL texts by way of the query option

_JOIN = "SELECT c_mktsegment, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_totalprice > 300000"
_AGG = "SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderpriority"


def _views(spark, sf_dir, *names):
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


@query(_JOIN)
def query_option_join(spark, sf_dir):
    _views(spark, sf_dir, "customer", "orders")
    return Bridge(spark).read(query=_JOIN + ";")


@query(_AGG)
def query_option_agg(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    return Bridge(spark).read(query=_AGG, table="is_not_read")


@query(f"SELECT * FROM ({_AGG}) WHERE n > 5")
def query_option_pushdown(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    return Bridge(spark).read(query=_AGG).where("n > 5")


@query("SELECT count(*) AS n, count(DISTINCT l_suppkey) AS suppliers FROM lineitem")
def scan_num_partitions(spark, sf_dir):
    """Fewer and more partitions than the scan has."""
    b, at = Bridge(spark), f"lakespan_src_lineitem_{zlib.crc32(sf_dir.encode()):08x}"
    table(spark, sf_dir, "lineitem")
    few, many = b.read(table=at, num_partitions=1), b.read(table=at, num_partitions=7)
    assert (few.rdd.getNumPartitions(), many.rdd.getNumPartitions()) == (1, 7)
    return few.agg(F.count("*").alias("n"), F.countDistinct("l_suppkey").alias("suppliers"))


@query("SELECT n_regionkey, count(*) AS n, (SELECT count(*) FROM nation) AS total FROM nation GROUP BY ALL")
def scan_cached(spark, sf_dir):
    n = table(spark, sf_dir, "nation").cache()
    total = n.count()
    return n.groupBy("n_regionkey").agg(F.count("*").alias("n")).withColumn("total", F.lit(total).cast(T.LongType()))
