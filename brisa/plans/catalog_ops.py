"""Queries that exercise single operators, scalar functions, the quality suite
and the file jobs on the test tables; registered into ``catalog.QUERIES``."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as bf
from ..operators.joins import equi_join, with_membership_flag
from ..operators.topn import total_order
from ..operators.windows import dedup_latest, first_per_key, mode_per_key
from ..session import scratch_path
from ..functions.scalars import file_month, month_start
from ..sources import files, jobs, ledger, merging, schemas
from ..streaming import landing
from . import incremental, tpch_quality, warehouse
from .catalog import M, ntz, register
from .oracle_sql import B, rnd, sdiv, sql
from .tpch import CALENDAR, table

# --- windows -------------------------------------------------------------------


@register(
    "dedup_latest",
    sql(
        """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
      l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST,
      l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS rn
  FROM lineitem) t WHERE rn = 1"""
    ),
)
def q_dedup_latest(spark, d):
    """Latest row per (l_orderkey, l_linenumber), fully tie-broken."""
    li = table(spark, d, "lineitem")
    return dedup_latest(li, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc_nulls_last()])


@register(
    "first_per_key",
    sql(
        """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS LAST, o_orderkey NULLS FIRST,
      o_orderstatus NULLS FIRST, o_totalprice NULLS FIRST, o_orderpriority NULLS FIRST) AS rn
  FROM orders) t WHERE rn = 1"""
    ),
)
def q_first_per_key(spark, d):
    """First order of every customer."""
    return first_per_key(table(spark, d, "orders"), "o_custkey", "o_orderdate")


@register(
    "mode_per_key",
    sql(
        """SELECT l_suppkey, l_returnflag, l_linestatus, obs_count FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY obs_count DESC, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS rn
  FROM (SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS obs_count FROM lineitem GROUP BY 1, 2, 3) c) t WHERE rn = 1"""
    ),
)
def q_mode_per_key(spark, d):
    """Most frequent (return flag, line status) per supplier."""
    return mode_per_key(table(spark, d, "lineitem"), "l_suppkey", ["l_returnflag", "l_linestatus"])


# --- joins -----------------------------------------------------------------------


@register(
    "join_inner",
    sql(
        """SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, o.o_custkey, o.o_orderpriority
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""
    ),
)
def q_join_inner(spark, d):
    """Inner equi-join of the two largest tables (shuffle join; sized by the planner)."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return equi_join(li, o, [("l_orderkey", "o_orderkey")]).drop("o_orderkey")


@register(
    "join_using",
    sql(
        """SELECT o_custkey, o_orderkey, o_totalprice, c_nationkey, c_mktsegment
FROM orders JOIN (SELECT c_custkey AS o_custkey, c_nationkey, c_mktsegment FROM customer) c USING (o_custkey)"""
    ),
)
def q_join_using(spark, d):
    """Join USING one key column."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    return o.join(c, ["o_custkey"])


@register(
    "join_left_dim",
    sql(
        """SELECT s.movement_id, s.carrier, dc.carrier_name, dc.is_active
FROM stg_movements s LEFT JOIN dim_carrier dc ON s.carrier = dc.carrier"""
    ),
)
def q_join_left_dim(spark, d):
    """Movements left-joined to the carrier dimension."""
    m = M(spark, d)
    dc = m.dim_carrier().select(F.col("carrier").alias("__c"), "carrier_name", "is_active")
    j = m.stg_movements().select("movement_id", "carrier").join(dc, F.col("carrier") == F.col("__c"), "left")
    return j.drop("__c")


@register(
    "in_set_aggregate",
    sql(
        """SELECT carrier, count(*) FILTER (WHERE origin IN (SELECT station FROM hubs)) AS hub_departures,
       count(*) AS movements
FROM stg_movements GROUP BY carrier"""
    ),
)
def q_in_set_aggregate(spark, d):
    """``countif(x in (subquery))`` via a precomputed broadcast flag."""
    m = M(spark, d)
    f = with_membership_flag(m.stg_movements().select("carrier", "origin"), "origin", m.hubs(), "station", "from_hub")
    return f.groupBy("carrier").agg(bf.count_where(F.col("from_hub")).alias("hub_departures"), F.count(F.lit(1)).alias("movements"))


# --- aggregates and predicates --------------------------------------------------


@register(
    "agg_sum_and_conditional_sum",
    sql(
        f"""SELECT l_returnflag, {rnd("sum(l_extendedprice)", 2)} AS revenue,
       {rnd("sum(CASE WHEN l_discount > 0.05 THEN l_extendedprice END)", 2)} AS discounted_revenue,
       {rnd(sdiv("sum(l_extendedprice * l_quantity)", "sum(l_quantity)"), 4)} AS qty_weighted_price
FROM lineitem GROUP BY l_returnflag"""
    ),
)
def q_agg_sum(spark, d):
    """Sum, conditional sum and weighted mean."""
    li = table(spark, d, "lineitem")
    return li.groupBy("l_returnflag").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("revenue"),
        F.round(bf.cond_sum(F.col("l_discount") > 0.05, "l_extendedprice"), 2).alias("discounted_revenue"),
        F.round(bf.weighted_avg("l_extendedprice", "l_quantity"), 4).alias("qty_weighted_price"),
    )


@register(
    "agg_global",
    sql(
        f"""SELECT count(*) AS n_orders, {rnd("avg(o_totalprice)", 4)} AS avg_price,
       {rnd("stddev_samp(o_totalprice)", 4)} AS stddev_price,
       {rnd("corr(o_totalprice, CAST(o_orderkey AS DOUBLE))", 6)} AS price_key_corr,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS finished
FROM orders"""
    ),
)
def q_agg_global(spark, d):
    """One aggregate row over the whole table."""
    o = table(spark, d, "orders")
    return o.agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.round(F.avg("o_totalprice"), 4).alias("avg_price"),
        F.round(F.stddev_samp("o_totalprice"), 4).alias("stddev_price"),
        F.round(bf.pearson("o_totalprice", "o_orderkey"), 6).alias("price_key_corr"),
        bf.count_where(F.col("o_orderstatus") == "F").alias("finished"),
    )


@register(
    "agg_by_expression",
    sql(
        """SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS order_quarter,
       count(*) AS n_orders
FROM orders GROUP BY 1, 2"""
    ),
)
def q_agg_by_expression(spark, d):
    """Group by computed expressions."""
    o = table(spark, d, "orders")
    return o.groupBy(F.year("o_orderdate").alias("order_year"), bf.quarter_start("o_orderdate").alias("order_quarter")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )


@register(
    "having_threshold",
    sql("SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey HAVING count(*) >= 12"),
)
def q_having(spark, d):
    """Threshold applied after aggregation."""
    o = table(spark, d, "orders")
    return o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders")).filter(F.col("n_orders") >= 12)


@register(
    "year_range_filter",
    sql(f"SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date FROM orders WHERE year(o_orderdate) = {B}"),
)
def q_year_range(spark, d):
    """Year filter written as a half-open range so both bounds reach the Parquet scan."""
    o = table(spark, d, "orders")
    return o.filter(bf.in_year("o_orderdate", B)).select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date"))


@register(
    "both_metrics_present",
    sql(
        """SELECT origin, destination, weather_sensitivity_index, shock_sensitivity_index FROM route_risk
WHERE weather_sensitivity_index IS NOT NULL AND shock_sensitivity_index IS NOT NULL"""
    ),
)
def q_both_present(spark, d):
    """Rows with both indices present."""
    r = M(spark, d).route_risk().select("origin", "destination", "weather_sensitivity_index", "shock_sensitivity_index")
    return r.dropna(subset=["weather_sensitivity_index", "shock_sensitivity_index"])


@register(
    "star_and_cte",
    sql(
        """WITH per_nation AS (SELECT c_nationkey, count(*) AS customers, CAST(sum(c_acctbal > 0) AS BIGINT) AS positive
                    FROM customer GROUP BY c_nationkey)
SELECT * FROM per_nation"""
    ),
)
def q_star_and_cte(spark, d):
    """A named sub-result selected with ``*``."""
    c = table(spark, d, "customer")
    per_nation = c.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("customers"), bf.count_where(F.col("c_acctbal") > 0).alias("positive")
    )
    per_nation.createOrReplaceTempView("per_nation")
    return spark.sql("SELECT * FROM per_nation")


@register("total_order", sql("SELECT hub, month, total_movements FROM recovery ORDER BY hub, month"))
def q_total_order(spark, d):
    """O1: range-partitioned global sort of a mart."""
    return total_order(M(spark, d).recovery().select("hub", "month", "total_movements"), ["hub", "month"])


# --- scalar functions ------------------------------------------------------------


@register(
    "scalar_strings",
    sql(
        """SELECT p_partkey, trim('  ' || p_name || '  ') AS name_trimmed, substr(p_type, 1, 3) AS type_prefix,
       p_brand || ' -> ' || p_type AS brand_type, p_brand || nullif(p_type, 'LARGE') AS brand_type_or_null
FROM part"""
    ),
)
def q_scalar_strings(spark, d):
    """F1 trim, F3 prefix, F4 null-propagating concatenation."""
    p = table(spark, d, "part")
    return p.select(
        "p_partkey",
        F.trim(F.concat(F.lit("  "), F.col("p_name"), F.lit("  "))).alias("name_trimmed"),
        bf.prefix("p_type", 3).alias("type_prefix"),
        F.concat(F.col("p_brand"), F.lit(" -> "), F.col("p_type")).alias("brand_type"),
        F.concat(F.col("p_brand"), F.nullif(F.col("p_type"), F.lit("LARGE"))).alias("brand_type_or_null"),
    )


@register(
    "scalar_casts_and_dates",
    sql(
        f"""SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS key_text,
       CAST(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS order_date,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter_start,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year,
       CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week, CAST(strftime(o_orderdate, '%U') AS INTEGER) AS week_of_year,
       monthname(o_orderdate) AS month_name, dayname(o_orderdate) AS day_name,
       CAST(date_diff('day', DATE '{B}-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days_from_base,
       abs(CAST(date_diff('day', DATE '{B}-01-01', CAST(o_orderdate AS DATE)) AS INTEGER)) AS abs_days_from_base
FROM orders"""
    ),
)
def q_scalar_dates(spark, d):
    """F6 cast, F8 parse, F12 truncation, F13-F16 extraction and names, F17 day difference."""
    o = table(spark, d, "orders")
    day = F.col("o_orderdate").cast("date")
    diff = F.datediff(day, F.lit(f"{B}-01-01").cast("date"))
    return o.select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.to_date(F.date_format("o_orderdate", "yyyy-MM-dd"), "yyyy-MM-dd").alias("order_date"),
        bf.month_start("o_orderdate").alias("month_start"),
        bf.quarter_start("o_orderdate").alias("quarter_start"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofyear(day).alias("day_of_year"),
        F.dayofweek(day).alias("day_of_week"),
        bf.sunday_week(day).alias("week_of_year"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
        diff.alias("days_from_base"),
        F.abs(diff).alias("abs_days_from_base"),
    )


@register(
    "scalar_null_logic",
    sql(
        """SELECT p_partkey, nullif(trim(p_type), 'LARGE') AS type_or_null,
       coalesce(nullif(trim(p_type), 'LARGE'), 'unknown') AS type_default,
       CASE WHEN p_size > 25 THEN 'big' END AS size_label,
       trim(CASE WHEN p_size > 25 THEN p_type END) = 'PROMO' AS promo_three_valued,
       coalesce(trim(CASE WHEN p_size > 25 THEN p_type END) = 'PROMO', false) AS promo_or_false,
       CASE WHEN trim(p_type) IN ('LARGE', 'SMALL') THEN NULL ELSE p_type END AS type_tokens_nulled
FROM part"""
    ),
)
def q_scalar_null_logic(spark, d):
    """F2 sentinel to null, F7 coalesce, F21 case without else, F22 three-valued flags, N1 token nulls."""
    p = table(spark, d, "part")
    big_type = F.when(F.col("p_size") > 25, F.col("p_type"))
    return p.select(
        "p_partkey",
        bf.null_sentinel("p_type", "LARGE").alias("type_or_null"),
        F.coalesce(bf.null_sentinel("p_type", "LARGE"), F.lit("unknown")).alias("type_default"),
        F.when(F.col("p_size") > 25, F.lit("big")).alias("size_label"),
        bf.flag_equals(big_type, "PROMO").alias("promo_three_valued"),
        bf.flag_equals(big_type, "PROMO", null_as=False).alias("promo_or_false"),
        bf.normalize_nulls("p_type", ["LARGE", "SMALL"]).alias("type_tokens_nulled"),
    )


@register(
    "scalar_math",
    sql(
        f"""SELECT l_orderkey, l_linenumber, l_partkey, {rnd("l_extendedprice * (1 - l_discount)", 2)} AS net_price,
       {sdiv("l_tax", "l_discount")} AS tax_per_discount,
       round((epoch_ms(l_shipdate) - epoch_ms(TIMESTAMP '{B}-01-01 00:00:00')) / CAST(60000.0 AS DOUBLE), 2) AS minutes_from_base
FROM lineitem"""
    ),
)
def q_scalar_math(spark, d):
    """F18 rounding, F19 safe division (null on zero), F20 duration arithmetic."""
    li = table(spark, d, "lineitem")
    base_ms = bf.epoch_millis(F.lit(f"{B}-01-01 00:00:00").cast("timestamp"))
    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")), 2).alias("net_price"),
        bf.safe_divide("l_tax", "l_discount").alias("tax_per_discount"),
        bf.minutes_between(base_ms, bf.epoch_millis("l_shipdate")).alias("minutes_from_base"),
    )


@register(
    "scalar_regex_and_element",
    sql(
        """SELECT p_partkey, regexp_extract(p_name, '^(\\w+) ', 1) AS first_word, split_part(p_name, ' ', 2) AS second_word,
       CAST(NULLIF(regexp_extract(p_brand, '#(\\d+)$', 1), '') AS INTEGER) AS brand_number
FROM part"""
    ),
)
def q_scalar_regex(spark, d):
    """F24 regex capture, F23 array element by offset."""
    p = table(spark, d, "part")
    return p.select(
        "p_partkey",
        F.regexp_extract("p_name", r"^(\w+) ", 1).alias("first_word"),
        F.split("p_name", " ").getItem(1).alias("second_word"),
        F.nullif(F.regexp_extract("p_brand", r"#(\d+)$", 1), F.lit("")).cast("int").alias("brand_number"),
    )


@register(
    "epoch_safe",
    sql(
        f"""SELECT l_orderkey, l_linenumber,
       CASE WHEN epoch_ms(l_shipdate) BETWEEN {-62135596800000} AND {253402300799999} THEN epoch_ms(epoch_ms(l_shipdate)) END AS shipped_at,
       CASE WHEN epoch_ms(l_shipdate) * 2 BETWEEN {-62135596800000} AND {253402300799999} THEN epoch_ms(epoch_ms(l_shipdate) * 2) END AS scaled_2,
       CASE WHEN epoch_ms(l_shipdate) * 1000 BETWEEN {-62135596800000} AND {253402300799999} THEN epoch_ms(epoch_ms(l_shipdate) * 1000) END AS scaled_1000
FROM lineitem"""
    ),
)
def q_epoch_safe(spark, d):
    """epoch milliseconds to timestamp, null when out of the year 1-9999 range."""
    li = table(spark, d, "lineitem")
    ms = bf.epoch_millis("l_shipdate")
    return ntz(
        li.select(
            "l_orderkey",
            "l_linenumber",
            bf.safe_timestamp_millis(ms).alias("shipped_at"),
            bf.safe_timestamp_millis(ms * 2).alias("scaled_2"),
            bf.safe_timestamp_millis(ms * 1000).alias("scaled_1000"),
        )
    )


@register(
    "epoch_nanos",
    sql(
        """SELECT event_id, epoch_us(ts) * 1000 + 999 AS ts_nanos, make_timestamp((epoch_us(ts) * 1000 + 999) // 1000) AS ts_back,
       date_trunc('hour', make_timestamp((epoch_us(ts) * 1000 + 999) // 1000)) AS ts_hour
FROM events"""
    ),
)
def q_epoch_nanos(spark, d):
    """F10 nanoseconds to timestamp by integer division, F11 hour bucket."""
    e = table(spark, d, "events")
    nanos = F.unix_micros(F.col("ts").cast("timestamp")) * F.lit(1000) + F.lit(999)
    return ntz(
        e.select(
            "event_id",
            nanos.alias("ts_nanos"),
            bf.nanos_to_timestamp(nanos).alias("ts_back"),
            bf.hour_bucket(bf.nanos_to_timestamp(nanos)).alias("ts_hour"),
        )
    )


@register("carrier_prefix", sql("SELECT substr(callsign, 1, 3) AS carrier, count(*) AS movements FROM raw_movements GROUP BY 1"))
def q_carrier_prefix(spark, d):
    """carrier code as the first three characters of the call sign."""
    r = M(spark, d).raw_movements()
    return r.groupBy(bf.prefix("callsign", 3).alias("carrier")).agg(F.count(F.lit(1)).alias("movements"))


@register(
    "surrogate_key",
    sql(
        """SELECT event_id, md5(concat_ws('-', coalesce(CAST(event_id AS VARCHAR), '__null__'), coalesce(CAST(user_id AS VARCHAR), '__null__'),
       coalesce(CAST(ts AS VARCHAR), '__null__'), coalesce(CAST(NULL AS VARCHAR), '__null__'))) AS event_key
FROM events"""
    ),
)
def q_surrogate_key(spark, d):
    """null-safe hash of several columns."""
    e = table(spark, d, "events")
    return e.select("event_id", bf.surrogate_key("event_id", "user_id", "ts", F.lit(None).cast("string")).alias("event_key"))


@register(
    "explode_parallel_arrays",
    sql(
        """SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS time, l_quantity AS quantity,
       l_extendedprice AS price, CAST(l_shipdate AS DATE) AS obs_date FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, strftime(l_shipdate + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS time, l_quantity * 2 AS quantity,
       l_extendedprice * (1 - l_discount) AS price, CAST(l_shipdate + INTERVAL 1 HOUR AS DATE) AS obs_date FROM lineitem"""
    ),
)
def q_explode_arrays(spark, d):
    """A struct of parallel arrays per row becomes one row per index."""
    li = table(spark, d, "lineitem")
    t0 = F.col("l_shipdate")
    t1 = F.col("l_shipdate") + F.expr("INTERVAL 1 HOUR")
    payload = li.select(
        "l_orderkey",
        "l_linenumber",
        F.struct(
            F.array(F.date_format(t0, "yyyy-MM-dd HH:mm:ss"), F.date_format(t1, "yyyy-MM-dd HH:mm:ss")).alias("time"),
            F.array(F.col("l_quantity"), F.col("l_quantity") * 2).alias("quantity"),
            F.array(F.col("l_extendedprice"), F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("price"),
        ).alias("hourly"),
    )
    return files.explode_parallel_arrays(payload, "hourly", keep=["l_orderkey", "l_linenumber"])


# --- data quality ----------------------------------------------------------------

for _name, _fn in tpch_quality.GROUPS.items():
    register(_name, sql(tpch_quality.SQL_BODIES[_name]))((lambda fn: lambda spark, d: fn(M(spark, d)))(_fn))

register("dq_summary", sql(tpch_quality.SQL_BODIES["dq_summary"]))(lambda spark, d: tpch_quality.summary(M(spark, d)))


# --- file jobs (write to the shared checkpoint folder, read back) ------------------

CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)
NATION_SCHEMA = T.StructType(
    [T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()), T.StructField("n_regionkey", T.IntegerType())]
)


@register("land_csv_roundtrip", sql("SELECT * FROM customer"))
def q_land_csv(spark, d):
    """S1 + N1 + X3: gzip CSV landed with a schema, nulls normalised, row count observed during the write."""
    src = scratch_path(spark, "customer_csv")
    table(spark, d, "customer").write.mode("overwrite").option("header", True).option("compression", "gzip").csv(src)
    landed = files.land_csv(spark, src, CUSTOMER_SCHEMA)
    out = scratch_path(spark, "customer_landed")
    files.load_summary(landed, out)
    return spark.read.parquet(out)


@register("headerless_csv", sql("SELECT * FROM nation"))
def q_headerless(spark, d):
    """Headerless CSV read with supplied names and types."""
    src = scratch_path(spark, "nation_csv")
    table(spark, d, "nation").write.mode("overwrite").option("header", False).csv(src)
    return files.read_csv_headerless(spark, src, NATION_SCHEMA)


@register("partitioned_roundtrip", sql("SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders"))
def q_partitioned(spark, d):
    """X2 + S4 + S6: month partitions clustered by customer, read back with partition discovery."""
    out = scratch_path(spark, "orders_by_month")
    files.write_layout(table(spark, d, "orders"), out, "o_orderdate", cluster=["o_custkey"])
    return spark.read.parquet(out)


@register(
    "interleaved_layout",
    sql("""SELECT 'second key' AS filtered, l_suppkey AS key, count(*) AS n, min(l_orderkey) AS first_order FROM lineitem WHERE l_suppkey BETWEEN 20 AND 24 GROUP BY 2
UNION ALL
SELECT 'third key', date_part('year', l_shipdate) * 10000 + date_part('month', l_shipdate) * 100 + date_part('day', l_shipdate), count(*), min(l_orderkey) FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-03-31' GROUP BY 2"""),
)
def q_interleaved(spark, d):
    """Line items in Z-order over part, supplier and date; filters on the second and on the third key alone, which skip most row groups."""
    out = scratch_path(spark, "line_items_interleaved")
    files.write_layout(table(spark, d, "lineitem"), out, None, ["l_partkey", "l_suppkey", "l_shipdate"], interleave=True, row_group_bytes=1 << 18)
    li = spark.read.parquet(out)
    day = F.date_format("l_shipdate", "yyyyMMdd").cast("long")
    found = [
        ("second key", li.filter(F.col("l_suppkey").between(20, 24)).withColumn("key", F.col("l_suppkey"))),
        ("third key", li.filter(F.col("l_shipdate").between(F.lit("1997-03-01").cast("timestamp_ntz"), F.lit("1997-03-31").cast("timestamp_ntz"))).withColumn("key", day)),
    ]
    frames = [f.groupBy(F.lit(name).alias("filtered"), "key").agg(F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("first_order")) for name, f in found]
    return frames[0].unionByName(frames[1])


def _make_folder(spark, path):
    """An empty delivery has a folder too."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


@register(
    "incremental_build",
    sql("SELECT 'N' || hub AS hub, month, year, total_movements, baseline_movements, recovery_ratio, movement_delta, phase FROM recovery"),
)
def q_incremental_build(spark, d):
    """S5 + X1: hub recovery after a full build and an update.

    The movements of two months (one of them in the base year) come in two
    deliveries; the update after the second replaces those months, and what
    compares with the base-year one, in the tables of the first build.
    """
    m = M(spark, d)
    root = scratch_path(spark, "incremental")
    station = lambda c: F.concat(F.lit("N"), F.col(c))
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")

    def shaped(df, schema, given):
        return df.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])

    raw = m.raw_movements().withColumns({"origin": station("origin"), "destination": station("destination")})
    flights = shaped(raw, schemas.FLIGHTS_RAW, {c: F.col(c) for c in raw.columns}).withColumn("dt", F.trunc(F.col("day").cast("date"), "month"))
    late = F.coalesce((F.col("registration") == "R") & F.col("dt").cast("string").isin(f"{B}-03-01", f"{B + 2}-06-01"), F.lit(False))
    # Both deliveries come from one pass over the joined tables; months larger than a task's share are split.
    deliveries, first = f"{root}/deliveries", f"{root}/deliveries/late=0"
    _make_folder(spark, first)
    flights = flights.withColumn("late", late.cast("int")).hint("rebalance", F.col("late"), F.col("dt"))
    flights.write.mode("append").partitionBy("late", "dt").parquet(deliveries)
    landed = spark.read.schema(T.StructType([*schemas.FLIGHTS_RAW.fields, T.StructField("late", T.IntegerType()), T.StructField("dt", T.DateType())])).parquet(deliveries)
    seen = m.raw_observations().select(station("station").alias("airport_icao"), "obs_time", "obs_date", (F.col("balance") / 400).alias("snowfall"))
    shaped(seen, schemas.WEATHER_RAW, {c: F.col(c) for c in seen.columns}).write.parquet(f"{root}/weather")
    places = m.places().select(station("station").alias("ident"), F.col("place_name").alias("name"), F.lit("large_airport").alias("type"), F.col("country").alias("iso_country"))
    shaped(places, schemas.AIRPORTS_RAW, {c: F.col(c) for c in places.columns}).write.option("header", True).csv(f"{root}/airports")
    shaped(m.raw_carriers(), schemas.AIRLINES_RAW, {c: F.col(c) for c in m.raw_carriers().columns}).write.csv(f"{root}/airlines")
    routes = m.raw_routes(landed.withColumns({c: F.expr(f"substring({c}, 2)") for c in ("origin", "destination")}))
    shaped(routes, schemas.ROUTES_RAW, {c: F.col(c) for c in routes.columns}).write.csv(f"{root}/routes")
    hubs = m.hubs().select(station("station").alias("station"), text.alias("iata"), F.col("place_name").alias("name"), "country", number.alias("latitude"), number.alias("longitude"))
    hubs.write.option("header", True).csv(f"{root}/hubs")
    inp = warehouse.Inputs(first, *[f"{root}/{n}" for n in ("weather", "airports", "airlines", "routes")], hub_seed=f"{root}/hubs")
    incremental.build(spark, inp, f"{root}/out", CALENDAR)
    landed.filter("late = 1").drop("late").write.mode("append").partitionBy("dt").parquet(first)
    incremental.build(spark, inp, f"{root}/out", CALENDAR)
    return spark.read.parquet(f"{root}/out/hub_recovery").select(
        "hub", "month", "year", "total_movements", "baseline_movements", "recovery_ratio", "movement_delta", "phase"
    )


@register("harmonised_types", sql("SELECT * FROM lineitem"))
def q_harmonised(spark, d):
    """Files whose quantity column drifted to BIGINT are unified as DOUBLE; 250 files of either type, whose footers one job reads."""
    li = table(spark, d, "lineitem")
    a = scratch_path(spark, "li_int")
    b = scratch_path(spark, "li_double")
    returned = F.col("l_returnflag").eqNullSafe("R")
    li.filter(returned).withColumn("l_quantity", F.col("l_quantity").cast("long")).repartition(250).write.parquet(a)
    li.filter(~returned).repartition(250).write.parquet(b)
    return files.read_harmonised(spark, [a, b], ["l_quantity"], schema=li.schema)


@register("load_file_list", sql("SELECT * FROM orders"))
def q_load_file_list(spark, d):
    """An explicit list of files (here one folder per order status) loaded as one table with a schema."""
    o = table(spark, d, "orders")
    place = scratch_path(spark, "orders_by_status")
    states = ["F", "O", "P"]
    other = ~F.coalesce(F.col("o_orderstatus").isin(states), F.lit(False))
    parts = {s: o.filter(F.col("o_orderstatus") == s) for s in states} | {"other": o.filter(other)}
    for name, rows in parts.items():
        rows.write.parquet(f"{place}/{name}")
    return files.load_parquet(spark, [f"{place}/{name}" for name in parts], o.schema)


@register("landed_row_count", sql("SELECT count(*) AS rows_written FROM customer"))
def q_landed_row_count(spark, d):
    """The number of rows that a load reports, counted while it writes."""
    rows = files.load_summary(table(spark, d, "customer"), scratch_path(spark, "customer_counted"))
    return spark.range(1).select(F.lit(rows).cast("long").alias("rows_written"))


@register("materialised_table", sql("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1"))
def q_materialised(spark, d):
    """X1 + S6: a model written as a table and read back with its schema."""
    counts = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "orders_per_customer")
    files.materialise(counts, "orders_per_customer", kind="table", path=path)
    return files.load_parquet(spark, path, counts.schema)


@register(
    "seed_columns_by_name",
    sql("SELECT 'N' || n_nationkey AS station, n_name AS iata, n_name AS name, 'C' || n_regionkey AS country, "
        "n_nationkey / 4.0 AS latitude, n_regionkey / 2.0 AS longitude FROM nation"),
)
def q_seed_by_name(spark, d):
    """S11 + S12: a headered file with its columns in another order, one renamed and one to spare."""
    n = table(spark, d, "nation")
    path = scratch_path(spark, "turned_seed")
    n.select(
        (F.col("n_regionkey") / 2).alias("longitude"),
        F.lit("spare").alias("remark"),
        F.concat(F.lit("C"), F.col("n_regionkey")).alias("country"),
        F.concat(F.lit("N"), F.col("n_nationkey")).alias("airport_icao"),
        F.col("n_name").alias("name"),
        (F.col("n_nationkey") / 4).alias("latitude"),
        F.col("n_name").alias("iata"),
    ).write.option("header", True).csv(path)
    return files.read_seed(spark, path)


@register("file_months", sql("SELECT make_date(1995, 1 + n_regionkey::INT, 1) AS dt, count(*) AS n FROM nation GROUP BY 1"))
def q_file_months(spark, d):
    """The month of each row from its source file's path, one folder per month."""
    n = table(spark, d, "nation")
    path = scratch_path(spark, "monthly")
    n.withColumn("file", F.format_string("flightlist_1995%02d01_1995%02d28", F.col("n_regionkey") + 1, F.col("n_regionkey") + 1)).write.partitionBy("file").parquet(path)
    src = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    rows = spark.read.parquet(path).withColumn("dt", file_month(F.concat(F.regexp_replace(src, "^file=", ""), F.lit(".csv.gz"))))
    return rows.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


ORDERS_CSV_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


@register(
    "ledger_landing",
    sql("""WITH landed AS (
  SELECT *, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS dt FROM orders
  UNION ALL
  SELECT * REPLACE ('again' AS o_orderstatus), make_date(1970, 1, 1) AS dt FROM orders
  WHERE o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED')
)
SELECT *, count(*) OVER (PARTITION BY dt) AS month_rows FROM landed"""),
)
def q_ledger_landing(spark, d):
    """S1 + S3: deliveries of CSV files landed through the file ledger.

    The first delivery is landed. The second brings a further file for every
    month; its landing is cut off between the data and the ledger and then run
    again. One more month has two files; the landing of the second is cut off
    between the ledger and the month folders and then run again. Each order must
    be there once, with its month's rows as the ledger has them.
    """
    o = table(spark, d, "orders")
    src, out = scratch_path(spark, "delivered"), scratch_path(spark, "ledger_landed")
    month = F.date_format(F.date_trunc("quarter", "o_orderdate"), "yyyyMM")
    urgent = F.coalesce(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit(False))

    def deliver(rows, folder):
        named = rows.withColumn("file", F.concat(F.lit("flightlist_"), F.coalesce(month, F.lit("none")), F.lit("01_19700101")))
        # One file a month and delivery; a gzip file is read by one task in any case.
        named.repartition("file").write.mode("overwrite").partitionBy("file").option("header", True).option("compression", "gzip").csv(f"{src}/{folder}")

    def month_of(path):
        return file_month(F.element_at(F.split(path, "/"), -2))

    def land(paths):
        return jobs.land_files(spark, paths, out, ORDERS_CSV_SCHEMA, month_of=month_of)

    def staged_only(paths):
        """What a run leaves behind that is killed after it wrote its data."""
        about = {"dt": month_of(F.col("_metadata.file_path")), "source": ledger.source_identity()}
        load = ledger.new_load(spark, out)
        ledger.stage(files.land_csv(spark, paths, ORDERS_CSV_SCHEMA, about=about), out, load)
        return load

    deliver(o.filter(urgent), "a")
    land(f"{src}/a/*/*.csv.gz")
    deliver(o.filter(~urgent), "b")
    staged_only(f"{src}/b/*/*.csv.gz")
    land(f"{src}/[ab]/*/*.csv.gz")
    for priority in ("3-MEDIUM", "4-NOT SPECIFIED"):
        again = o.filter(F.col("o_orderpriority") == priority).withColumns({"o_orderstatus": F.lit("again"), "file": F.lit("flightlist_19700101_19700131")})
        again.repartition("file").write.partitionBy("file").option("header", True).option("compression", "gzip").csv(f"{src}/{priority[0]}")
    land(f"{src}/3/*/*.csv.gz")
    load = staged_only(f"{src}/4/*/*.csv.gz")
    ledger.commit(ledger.listing(spark, f"{src}/4/*/*.csv.gz", month_of), out, load)
    land(f"{src}/*/*/*.csv.gz")
    counted = ledger.landed(spark, out).groupBy("dt").agg(F.sum("rows").alias("month_rows"))
    return spark.read.parquet(out).join(counted, "dt").select(*o.columns, "dt", "month_rows")


@register("only_new_partitions", sql("SELECT *, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders WHERE year(o_orderdate) > 1997"))
def q_only_new(spark, d):
    """S3: rows of partitions not landed yet, by anti-join on the partition key."""
    o = table(spark, d, "orders").withColumn("yr", F.year("o_orderdate"))
    out = scratch_path(spark, "orders_by_year")
    files.write_partitioned(o.filter(F.col("yr") <= 1997), out, ["yr"])
    return files.only_new_partitions(o, spark.read.parquet(out), "yr")


@register(
    "overwrite_partitions",
    sql(
        f"""SELECT *, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders
WHERE year(o_orderdate) != {B} OR o_orderpriority = '1-URGENT'"""
    ),
)
def q_overwrite(spark, d):
    """A re-run replaces only the partitions it writes (dynamic overwrite)."""
    o = table(spark, d, "orders").withColumn("yr", F.year("o_orderdate"))
    out = scratch_path(spark, "orders_overwrite")
    files.write_partitioned(o, out, ["yr"])
    files.overwrite_partitions(o.filter((F.col("yr") == B) & (F.col("o_orderpriority") == "1-URGENT")), out, ["yr"])
    return spark.read.parquet(out).select(*o.columns)


@register(
    "merge_latest",
    sql(
        """SELECT * EXCLUDE (rn) FROM (
  SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month, l_shipdate, l_orderkey, l_linenumber, l_quantity, l_linestatus,
         row_number() OVER (PARTITION BY l_suppkey, date_trunc('month', l_shipdate)
                            ORDER BY l_shipdate DESC NULLS LAST, l_orderkey NULLS FIRST, l_linenumber NULLS FIRST) AS rn
  FROM lineitem) t WHERE rn = 1"""
    ),
)
def q_merge_latest(spark, d):
    """W1 over time: last shipment of each supplier and month; filled lines land first, the others are merged into the months they touch."""
    li = table(spark, d, "lineitem").withColumn("ship_month", month_start("l_shipdate"))
    li = li.select("l_suppkey", "ship_month", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_linestatus")
    filled = F.col("l_linestatus").eqNullSafe("F")
    out = scratch_path(spark, "last_shipments")
    for batch in (li.filter(filled), li.filter(~filled)):
        merging.merge_latest(
            batch, out, ["l_suppkey", "ship_month"], [F.col("l_shipdate").desc_nulls_last()], ["ship_month"], ["l_orderkey", "l_linenumber"]
        )
    return spark.read.parquet(out).select(*li.columns)


HUB_SEED_SCHEMA = T.StructType(
    [
        T.StructField("station", T.IntegerType()),
        T.StructField("place_name", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("total_movements", T.LongType()),
    ]
)


@register("seed_csv_roundtrip", sql("SELECT * FROM hubs"))
def q_seed_roundtrip(spark, d):
    """S13 + S12: the ranked hub list written as one CSV file and read back as a seed."""
    out = scratch_path(spark, "hub_seed")
    files.write_small_csv(M(spark, d).hubs(), out, max_rows=1000)
    return files.read_csv(spark, out, HUB_SEED_SCHEMA)


@register("incremental_landing", sql("SELECT * FROM customer"))
def q_incremental(spark, d):
    """Streaming landing: two runs over a growing folder land each file exactly once."""
    c = table(spark, d, "customer")
    src = scratch_path(spark, "landing_src")
    sink = scratch_path(spark, "landing_sink")
    ckpt = scratch_path(spark, "landing_ckpt")
    early = F.coalesce(F.col("c_nationkey") < 12, F.lit(False))
    c.filter(early).write.option("header", True).csv(src + "/part_a")
    stream = landing.read_new_csv(spark, src + "/*", CUSTOMER_SCHEMA)
    landing.land_available(stream, sink, ckpt)
    c.filter(~early).write.option("header", True).csv(src + "/part_b")
    landing.land_available(landing.read_new_csv(spark, src + "/*", CUSTOMER_SCHEMA), sink, ckpt)
    landing.land_available(landing.read_new_csv(spark, src + "/*", CUSTOMER_SCHEMA), sink, ckpt)
    return spark.read.schema(CUSTOMER_SCHEMA).parquet(sink)


