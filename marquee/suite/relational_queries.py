"""Joins, filters, aggregates, windows, set operations, sources and published tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.operators.aggregates import (
    distinct_list,
    latest_per_key,
    mode_per_key,
    percentiles_per_key,
    share_of_total,
    with_group_total,
)
from marquee.operators.joins import band_join, merge_features, new_rows, not_in, small_side
from marquee.operators.quality import logged_write
from marquee.plans import forecast
from marquee.plans.publish import actual_metrics, decade_rollup, full_outer_metrics, predicted_metrics
from marquee.session import scratch_path
from marquee.sources import files
from marquee.sources.tables import ViewershipSource, calendar, sample_rows, scan, viewership
from marquee.suite import standins as s
from marquee.suite.registry import big, iso, query, rnd, us
from marquee.suite.standins import sql, ts


# --- joins ------------------------------------------------------------------------------


@query(
    "join_inner_multi_key",
    """
    select l_orderkey, l_linenumber, o_custkey, p_brand from lineitem join orders on o_orderkey = l_orderkey
    join part on p_partkey = l_partkey and p_size = l_linenumber
    """,
)
def join_inner(spark, d):
    lines = s.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), F.col("l_linenumber").alias("p_size")
    )
    part = s.table(spark, d, "part").select("p_partkey", "p_size", "p_brand")
    orders = s.table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return lines.join(small_side(part), ["p_partkey", "p_size"]).join(orders, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "o_custkey", "p_brand"
    )


@query(
    "join_left_default",
    "select c_custkey, coalesce(n, 0) as n_orders from customer left join "
    "(select o_custkey, count(*) as n from orders where o_orderstatus = 'F' group by 1) on o_custkey = c_custkey",
)
def join_left(spark, d):
    counts = s.table(spark, d, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return s.table(spark, d, "customer").select("c_custkey").join(counts, "c_custkey", "left").select(
        "c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders")
    )


@query(
    "join_right",
    "select p_partkey, total from (select l_partkey, round(sum(l_quantity), 2) as total from lineitem where l_discount = 0.1 "
    "group by 1) right join part on p_partkey = l_partkey",
)
def join_right(spark, d):
    totals = s.table(spark, d, "lineitem").where("l_discount = 0.1").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        rnd(F.sum("l_quantity"), 2).alias("total")
    )
    return totals.join(s.table(spark, d, "part").select("p_partkey"), "p_partkey", "right")


@query(
    "join_full_outer",
    "select coalesce(a.k, b.k) as k, a.n as n_big, b.n as n_small from "
    "(select o_custkey as k, count(*) as n from orders where o_totalprice > 400000 group by 1) a full join "
    "(select o_custkey as k, count(*) as n from orders where o_totalprice < 50000 group by 1) b on a.k = b.k",
)
def join_full(spark, d):
    orders = s.table(spark, d, "orders").withColumnRenamed("o_custkey", "k")
    many = orders.where("o_totalprice > 400000").groupBy("k").agg(F.count(F.lit(1)).alias("n_big"))
    few = orders.where("o_totalprice < 50000").groupBy("k").agg(F.count(F.lit(1)).alias("n_small"))
    return full_outer_metrics(many, few, ["k"])


@query(
    "join_case_insensitive",
    "select s_suppkey, n_name from supplier join nation on lower(n_name) = lower(replace(upper('nation_' || s_nationkey), 'X', ''))",
)
def join_lower(spark, d):
    left = s.table(spark, d, "supplier").withColumn(
        "_name", F.lower(F.upper(F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string"))))
    )
    right = s.table(spark, d, "nation").withColumn("_name", F.lower("n_name"))
    return left.join(small_side(right), "_name").select("s_suppkey", "n_name")


@query(
    "join_prefix",
    "select p_partkey, n from part join (select substr(p_name, 1, 3) as h, count(*) as n from part group by 1) on h = substr(p_name, 1, 3)",
)
def join_prefix(spark, d):
    part = s.table(spark, d, "part").select("p_partkey", F.substring("p_name", 1, 3).alias("h"))
    return part.join(part.groupBy("h").agg(F.count(F.lit(1)).alias("n")), "h").select("p_partkey", "n")


@query(
    "join_coalesced_key",
    "select c_custkey, s_name from customer join supplier on s_suppkey = coalesce(case when c_mktsegment = 'MACHINERY' then c_custkey end, c_nationkey)",
)
def join_coalesced(spark, d):
    key = F.coalesce(F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_custkey")), F.col("c_nationkey").cast("bigint"))
    left = s.table(spark, d, "customer").withColumn("s_suppkey", key)
    return left.join(s.table(spark, d, "supplier"), "s_suppkey").select("c_custkey", "s_name")


@query(
    "join_band",
    """
    select l_orderkey, l_linenumber from lineitem join orders on l_orderkey = o_orderkey
        and l_shipdate between o_orderdate + interval 10 day and o_orderdate + interval 40 day
    """,
)
def join_band(spark, d):
    orders = s.table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    day = F.make_dt_interval
    joined = band_join(
        s.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"), orders, ["l_orderkey"],
        "l_shipdate", F.col("o_orderdate") + day(days=F.lit(10)), F.col("o_orderdate") + day(days=F.lit(40)),
    )
    return joined.select("l_orderkey", "l_linenumber")


@query(
    "join_semi",
    "select o_orderkey from orders where o_orderkey in (select l_orderkey from lineitem where l_quantity = 50)",
)
def join_semi(spark, d):
    wanted = s.table(spark, d, "lineitem").where("l_quantity = 50").select(F.col("l_orderkey").alias("o_orderkey"))
    return s.table(spark, d, "orders").join(wanted, "o_orderkey", "left_semi").select("o_orderkey")


@query(
    "join_anti_new_rows",
    "select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')",
)
def join_anti(spark, d):
    recorded = s.table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return new_rows(s.table(spark, d, "customer").select("c_custkey"), recorded, ["c_custkey"])


@query(
    "filter_not_in",
    "select p_partkey from part where case when p_size > 3 then p_size end not in "
    "(select l_linenumber * 10 from lineitem where l_linenumber is not null)",
)
def filter_not_in(spark, d):
    listed = s.table(spark, d, "lineitem").select((F.col("l_linenumber") * 10).alias("v"))
    part = s.table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") > 3, F.col("p_size")).alias("size"))
    return not_in(part, "size", listed, "v").select("p_partkey")


@query(
    "merge_features",
    """
    with a as (select l_partkey as k, count(*) as n_lines from lineitem where l_tax = 0 group by 1),
        b as (select p_partkey as k, p_size from part where p_type <> 'PROMO')
    select coalesce(a.k, b.k) as k, n_lines, p_size from a full join b on a.k = b.k
    """,
)
def merged(spark, d):
    lines = s.table(spark, d, "lineitem").where("l_tax = 0").groupBy(F.col("l_partkey").alias("k")).agg(
        F.count(F.lit(1)).alias("n_lines")
    )
    sizes = s.table(spark, d, "part").where("p_type <> 'PROMO'").select(F.col("p_partkey").alias("k"), "p_size")
    return merge_features([lines, sizes], "k", "outer", first_only=True)


# --- filters ----------------------------------------------------------------------------


@query(
    "filter_suite",
    """
    select o_orderkey from orders where o_orderstatus in ('F', 'O') and o_orderpriority is not null
        and o_orderdate >= timestamp '1996-03-01' and o_orderdate < timestamp '1998-03-01'
        and o_totalprice between 100000 and 300000 and o_orderpriority like '%I%'
        and regexp_full_match(o_orderpriority, '[1-3]-[A-Z]+')
    """,
)
def filter_suite(spark, d):
    return s.table(spark, d, "orders").where(
        F.col("o_orderstatus").isin("F", "O")
        & F.col("o_orderpriority").isNotNull()
        & (F.col("o_orderdate") >= ts("1996-03-01 00:00:00"))
        & (F.col("o_orderdate") < ts("1998-03-01 00:00:00"))
        & F.col("o_totalprice").between(100000, 300000)
        & F.col("o_orderpriority").like("%I%")
        & F.col("o_orderpriority").rlike("^(?:[1-3]-[A-Z]+)$")
    ).select("o_orderkey")


@query(
    "filter_having",
    "select l_suppkey, round(sum(l_quantity), 2) as total from lineitem group by 1 having sum(l_quantity) > "
    "(select sum(l_quantity) from lineitem) / (select count(distinct l_suppkey) from lineitem)",
)
def filter_having(spark, d):
    lines = s.table(spark, d, "lineitem")
    totals = lines.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("total"))
    mean = totals.agg((F.sum("total") / F.count(F.lit(1))).alias("_mean"))
    return totals.crossJoin(F.broadcast(mean)).where("total > _mean").select("l_suppkey", rnd("total", 2).alias("total"))


@query(
    "filter_per_row_window",
    "select l_orderkey, l_linenumber from lineitem join orders on o_orderkey = l_orderkey "
    "where l_shipdate between o_orderdate and o_orderdate + to_days((l_linenumber * 5)::integer) and l_quantity >= 12",
)
def filter_per_row(spark, d):
    orders = s.table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = s.table(spark, d, "lineitem").where("l_quantity >= 12")
    closes = F.col("o_orderdate") + F.make_dt_interval(days=F.col("l_linenumber") * 5)
    return lines.join(orders, "l_orderkey").where(F.col("l_shipdate").between(F.col("o_orderdate"), closes)).select(
        "l_orderkey", "l_linenumber"
    )


@query(
    "filter_history",
    """
    select l_partkey from (select l_partkey, max(case when l_linenumber = 1 then l_quantity end) as a,
        max(case when l_linenumber = 2 then l_quantity end) as b, max(case when l_linenumber = 7 then l_quantity end) as c,
        max(l_shipdate) as m from lineitem group by 1)
    where a is not null and b is not null and c is not null and c <> 0 and m <= timestamp '2001-08-01' - interval 60 day
    """,
)
def filter_history(spark, d):
    def of(n):
        return F.max(F.when(F.col("l_linenumber") == n, F.col("l_quantity")))

    rows = s.table(spark, d, "lineitem").groupBy("l_partkey").agg(
        of(1).alias("a"), of(2).alias("b"), of(7).alias("c"), F.max("l_shipdate").alias("m")
    )
    known = F.col("a").isNotNull() & F.col("b").isNotNull() & F.col("c").isNotNull() & (F.col("c") != 0)
    return forecast.recent_history(rows.where(known), "m", ts("2001-08-01 00:00:00")).select("l_partkey")


# --- aggregates and windows ----------------------------------------------------------------


@query(
    "basic_aggs",
    """
    select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty, min(l_extendedprice) as min_price,
        max(l_extendedprice) as max_price, round(avg(l_discount), 6) as avg_disc, count(*) as n,
        count(distinct l_suppkey) as n_supp, round(ln(sum(l_tax + 1)), 6) as ln_tax
    from lineitem group by 1, 2
    """,
)
def basic_aggs(spark, d):
    return s.table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        rnd(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.min("l_extendedprice").alias("min_price"),
        F.max("l_extendedprice").alias("max_price"),
        rnd(F.avg("l_discount")).alias("avg_disc"),
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("l_suppkey").alias("n_supp"),
        rnd(F.log(F.sum(F.col("l_tax") + 1))).alias("ln_tax"),
    )


@query(
    "distinct_aggs",
    """
    select l_suppkey, count(distinct (l_partkey, l_linenumber)) as n_pairs,
        sum(distinct case when l_returnflag = 'A' then l_quantity else 0 end) as sum_distinct,
        count(distinct case when l_returnflag = 'R' then l_partkey end) as n_returned,
        count(distinct l_linenumber) as n_lines
    from lineitem group by 1
    """,
)
def distinct_aggs(spark, d):
    flag = F.col("l_returnflag")
    return s.table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.countDistinct("l_partkey", "l_linenumber").alias("n_pairs"),
        F.sum_distinct(F.when(flag == "A", F.col("l_quantity")).otherwise(0)).alias("sum_distinct"),
        F.count_distinct(F.when(flag == "R", F.col("l_partkey"))).alias("n_returned"),
        F.countDistinct("l_linenumber").alias("n_lines"),
    )


@query(
    "mode_and_list",
    """
    with m as (select l_suppkey, first(l_linenumber order by n desc, l_linenumber) as usual_line
            from (select l_suppkey, l_linenumber, count(*) as n from lineitem group by 1, 2) group by 1),
        f as (select l_suppkey, string_agg(distinct lower(l_returnflag), '|' order by lower(l_returnflag)) as flags from lineitem group by 1)
    select l_suppkey, usual_line, flags from m join f using (l_suppkey)
    """,
)
def mode_and_list(spark, d):
    lines = s.table(spark, d, "lineitem")
    flags = lines.groupBy("l_suppkey").agg(distinct_list(F.lower("l_returnflag")).alias("flags"))
    return mode_per_key(lines, ["l_suppkey"], "l_linenumber", "usual_line").join(flags, "l_suppkey")


@query(
    "percentiles",
    """
    select l_linenumber, round(median(l_extendedprice), 4) as p50, round(quantile_cont(l_extendedprice, 0.8), 4) as p80,
        round(quantile_cont(l_extendedprice, 0.05), 4) as p05 from lineitem group by 1
    """,
)
def percentiles(spark, d):
    rows = percentiles_per_key(
        s.table(spark, d, "lineitem"), ["l_linenumber"], "l_extendedprice", {"p50": 0.5, "p80": 0.8, "p05": 0.05}
    )
    return rows.select("l_linenumber", *[rnd(c, 4).alias(c) for c in ("p50", "p80", "p05")])


@query(
    "two_level_agg",
    "select l_suppkey, round(sum(m), 2) as total from (select l_suppkey, l_partkey, max(l_extendedprice) as m from lineitem group by 1, 2) group by 1",
)
def two_level(spark, d):
    per_part = s.table(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.max("l_extendedprice").alias("m"))
    return per_part.groupBy("l_suppkey").agg(rnd(F.sum("m"), 2).alias("total"))


@query(
    "share_of_total",
    "select l_suppkey, round(100 * sum(l_quantity) / (select sum(l_quantity) from lineitem), 6) as share from lineitem group by 1",
)
def shares(spark, d):
    totals = s.table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q"))
    return share_of_total(totals, "q", "share").select("l_suppkey", rnd("share").alias("share"))


@query(
    "latest_per_key",
    """
    select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey
        order by o_orderdate desc, o_orderkey desc) as r from orders) where r = 1
    """,
)
def latest(spark, d):
    return latest_per_key(
        s.table(spark, d, "orders"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], ["o_orderkey", "o_totalprice"]
    )


@query(
    "windows",
    """
    with m as (select o_custkey % 25 as g, date_trunc('month', o_orderdate) as mon, sum(o_totalprice) as v from orders group by 1, 2)
    select g, strftime(mon, '%Y-%m-%d') as month_start, round(sum(v) over (partition by g order by mon), 2) as running,
        round(sum(v) over (partition by g order by mon) / sum(v) over (partition by g), 6) as cum_share,
        round(v - coalesce(lag(v) over (partition by g order by mon), 0), 2) as step,
        epoch_us(first_value(mon) over (partition by g order by mon)) as first_us
    from m
    """,
)
def windows(spark, d):
    monthly = s.table(spark, d, "orders").groupBy(
        (F.col("o_custkey") % 25).alias("g"), F.trunc("o_orderdate", "month").alias("mon")
    ).agg(F.sum("o_totalprice").alias("v"))
    # at most one row per group and month
    w = Window.partitionBy("g").orderBy("mon")
    rows = with_group_total(monthly, ["g"], "v", "total")
    return rows.select(
        "g",
        iso("mon").alias("month_start"),
        rnd(F.sum("v").over(w), 2).alias("running"),
        rnd(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)) / F.col("total")).alias("cum_share"),
        rnd(F.col("v") - F.coalesce(F.lag("v").over(w), F.lit(0.0)), 2).alias("step"),
        us(F.min("mon").over(Window.partitionBy("g")).cast("timestamp")).alias("first_us"),
    )


@query(
    "last_signal_day",
    "select user_id, max(case when event_type = 'click' then day(ts) end) as last_day, count(*) as n from events group by 1",
)
def last_signal_day(spark, d):
    return s.table(spark, d, "events").groupBy("user_id").agg(
        big(F.max(F.when(F.col("event_type") == "click", F.dayofmonth("ts")))).alias("last_day"),
        F.count(F.lit(1)).alias("n"),
    )


# --- sort, limit, set operations -------------------------------------------------------------


@query(
    "set_union_distinct",
    "select c_nationkey as nation, 'c' as kind from customer where c_acctbal > 0 union select s_nationkey, 's' from supplier "
    "union select c_nationkey, 'c' from customer where c_acctbal < 5000",
)
def set_union(spark, d):
    customers = s.table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.lit("c").alias("kind"), "c_acctbal")
    suppliers = s.table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit("s").alias("kind"))
    return (
        customers.where("c_acctbal > 0").drop("c_acctbal")
        .unionByName(suppliers)
        .unionByName(customers.where("c_acctbal < 5000").drop("c_acctbal"))
        .distinct()
    )


@query(
    "set_concat_drift",
    "select c_custkey as k, c_acctbal as balance, null::varchar as name from customer union all select s_suppkey, null, s_name from supplier",
)
def set_concat(spark, d):
    customers = s.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("balance"))
    suppliers = s.table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query(
    "top_n",
    "select p_brand, n from (select p_brand, count(*) as n from part group by 1) order by n desc, p_brand limit 20",
)
def top_n(spark, d):
    return s.table(spark, d, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "p_brand").limit(20)


@query(
    "sort_nulls_first",
    "select c_custkey, b from (select c_custkey, case when c_acctbal > 0 then c_acctbal end as b from customer) order by b desc nulls first, c_custkey",
)
def sort_nulls(spark, d):
    rows = s.table(spark, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("b"))
    return rows.orderBy(F.desc_nulls_first("b"), "c_custkey")


@query("drop_duplicates", "select distinct o_custkey, o_orderstatus from orders")
def drop_duplicates(spark, d):
    return s.table(spark, d, "orders").select("o_custkey", "o_orderstatus").dropDuplicates()


@query(
    "decade_rollup",
    "select year(o_orderdate) // 10 * 10 as decade, count(o_orderkey) as movie_count, round(avg(o_totalprice), 4) as rating_mean from orders group by 1",
)
def decades(spark, d):
    titles = s.table(spark, d, "orders").select(
        F.year("o_orderdate").alias("year"), F.col("o_orderkey").alias("movie_title"), F.col("o_totalprice").alias("rating")
    )
    rolled = decade_rollup(titles)
    return rolled.select(big("decade").alias("decade"), "movie_count", rnd("rating_mean", 4).alias("rating_mean"))


# --- sources and sinks -----------------------------------------------------------------------


@query(
    "scan_pruned",
    "select l_orderkey, l_quantity from lineitem where l_shipdate >= timestamp '1999-01-01' and l_returnflag = 'R'",
)
def scan_pruned(spark, d):
    wanted = (F.col("l_shipdate") >= ts("1999-01-01 00:00:00")) & (F.col("l_returnflag") == "R")
    return scan(spark, f"{d}/lineitem.parquet", s.SCHEMAS["lineitem"], ["l_orderkey", "l_quantity"], wanted)


@query(
    "viewership_by_platform",
    "select 'current' as platform, event_id from events where event_type = 'view' and ts >= timestamp '2024-01-10' "
    "union all select 'legacy', event_id from events where event_type = 'click' and ts >= timestamp '2024-01-03'",
)
def viewership_by_platform(spark, d):
    path = f"{d}/events.parquet"
    sources = {
        "current": ViewershipSource(path, "2024-01-10 00:00:00", s.SCHEMAS["events"], "event_type = 'view'"),
        "legacy": ViewershipSource(path, "2024-01-03 00:00:00", s.SCHEMAS["events"], "event_type = 'click'"),
    }
    parts = [
        viewership(spark, name, sources, "ts").select(F.lit(name).alias("platform"), "event_id") for name in sources
    ]
    return parts[0].unionByName(parts[1])


@query(
    "calendar_coverage",
    "select strftime(d, '%Y-%m-%d') as day, count(event_id) as n from (select unnest(generate_series(date '2023-12-28', "
    "date '2024-02-03', interval 1 day))::date as d) left join events on ts::date = d group by 1",
)
def calendar_coverage(spark, d):
    days = calendar(spark, "2023-12-28", "2024-02-03")
    counts = s.table(spark, d, "events").groupBy(F.to_date("ts").alias("seq_date")).agg(F.count(F.lit(1)).alias("c"))
    return days.join(counts, "seq_date", "left").select(iso("seq_date").alias("day"), F.coalesce("c", F.lit(0)).alias("n"))


@query("sample_rows")
def sampled(spark, d):
    return sample_rows(s.table(spark, d, "orders"))


@query("sample_rows_check", "select 10::bigint as n_rows, 0::bigint as strangers")
def sampled_check(spark, d):
    """How many rows the sample has, and how many of them are not the table's."""
    orders = s.table(spark, d, "orders")
    some = sample_rows(orders)
    known = some.join(orders.select("o_orderkey", F.col("o_totalprice").alias("_price")), "o_orderkey", "left")
    return known.agg(
        F.count("*").alias("n_rows"), F.count_if(~F.col("o_totalprice").eqNullSafe(F.col("_price"))).alias("strangers")
    )


@query(
    "csv_roundtrip",
    "select s_suppkey, s_name, round(case when s_nationkey % 3 <> 0 then s_acctbal end, 2) as balance from supplier "
    "where s_suppkey not in (3, 7)",
)
def csv_roundtrip(spark, d):
    """Export with null marks and an all-null column; read back by name."""
    rows = s.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("S_SUPPKEY"),
        F.col("s_name").alias("'S_NAME'"),
        F.when(F.col("s_nationkey") % 3 != 0, F.col("s_acctbal")).alias("BALANCE"),
        F.lit(None).cast("string").alias("EMPTY"),
    )
    path = scratch_path(spark) + "/extract"
    files.write_csv(rows, path, quoted=True)
    back = files.read_csv_folder(spark, path, key="s_suppkey", excluded_keys=(3, 7))
    return back.select(big("s_suppkey").alias("s_suppkey"), "s_name", F.col("balance").cast("double").alias("balance"))


@query(
    "csv_by_position",
    "select c_custkey as k, case when c_mktsegment <> 'MACHINERY' then c_name end as name, '2024-01-29' as loaded "
    "from customer where c_acctbal >= 0",
)
def csv_by_position(spark, d):
    """Customers in debt get a key that is no number, so the loader must skip those rows."""
    rows = s.table(spark, d, "customer").select(
        F.when(F.col("c_acctbal") < 0, "broken").otherwise(F.col("c_custkey").cast("string")).alias("a"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name")).otherwise("").alias("b"),
    )
    path = scratch_path(spark) + "/part"
    files.write_csv(rows, path, quoted=True)
    loaded = files.load_by_position(spark, path, "k bigint, name string", "2024-01-29 12:00:00")
    return loaded.select("k", "name", iso("last_update_timestamp").alias("loaded"))


@query(
    "table_modes",
    "select c_custkey, c_nationkey, case when c_nationkey = 2 then 'rewritten' when c_nationkey < 12 then 'created' "
    "else 'appended' end as origin from customer",
)
def table_modes(spark, d):
    """Create, append, then rewrite one partition."""
    rows = s.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    path = scratch_path(spark) + "/customers"

    def part(where, origin):
        return rows.where(where).withColumn("origin", F.lit(origin))

    files.replace_table(part("c_nationkey < 12", "created"), path, ["c_nationkey"])
    files.append_table(part("c_nationkey >= 12", "appended"), path, ["c_nationkey"])
    files.replace_partitions(part("c_nationkey = 2", "rewritten"), path, ["c_nationkey"])
    return spark.read.parquet(path).select("c_custkey", "c_nationkey", "origin")


@query(
    "run_log",
    "select 'daily' as job, 'orders' as step, 'SUCCESS' as status, count(*) as row_count, 0::bigint as null_keys from orders",
)
def run_log(spark, d):
    folder = scratch_path(spark)
    log = logged_write(s.table(spark, d, "orders"), f"{folder}/orders", "daily", "orders", "o_orderkey", f"{folder}/log")
    return log.select("job", "step", "status", "row_count", "null_keys")


# --- published tables --------------------------------------------------------------------------

_PREDICTIONS = """
    select 'T' || o_custkey as title_name, 'M' || o_custkey as match_id, (o_custkey % 4 <> 0)::integer as platform_name,
        o_orderkey % 30 - 3 as pred_day, round(max(o_totalprice) / 1000000, 8) as pred
    from orders where o_orderstatus = '{status}' group by 1, 2, 3, 4"""
_DASH = {
    "pa": _PREDICTIONS.format(status="F"),
    "pv": _PREDICTIONS.format(status="O"),
    "fd": "select 'T' || c_custkey as title_name, 'M' || c_custkey as match_id, case when c_custkey % 3 = 0 then 'legacy' else 'current' end as platform_name from customer",
    "a": "select * from (select *, row_number() over (partition by title_name, platform_name order by pred_day desc) as r from pa) "
    "where r = 1 and platform_name = 1 and pred_day > 0",
    "v": "select p.* from (select *, row_number() over (partition by title_name, platform_name order by pred_day desc) as r from pv) p "
    "join fd on fd.title_name = p.title_name and fd.match_id = p.match_id and fd.platform_name = 'current' where r = 1 and p.platform_name = 1",
}


def _predictions(spark, d, status):
    key = F.col("o_custkey").cast("string")
    return (
        s.table(spark, d, "orders")
        .where(F.col("o_orderstatus") == status)
        .groupBy(
            F.concat(F.lit("T"), key).alias("title_name"), F.concat(F.lit("M"), key).alias("match_id"),
            (F.col("o_custkey") % 4 != 0).cast("int").alias("platform_name"), (F.col("o_orderkey") % 30 - 3).alias("pred_day"),
        )
        .agg(rnd(F.max("o_totalprice") / 1_000_000, 8).alias("percent_view_pred"))
    )


def _dashboard_titles(spark, d):
    key = F.col("c_custkey")
    return s.table(spark, d, "customer").select(
        F.concat(F.lit("T"), key.cast("string")).alias("title_name"),
        F.concat(F.lit("M"), key.cast("string")).alias("match_id"),
        F.when(key % 3 == 0, "legacy").otherwise("current").alias("platform_name"),
        ts("2024-01-01 00:00:00").alias("earliest_offered_timestamp"),
    )


@query(
    "dashboard_predicted",
    sql(
        "",
        "select distinct v.title_name, coalesce(a.match_id, v.match_id) as match_id, 28 as days_since_first_offered, "
        "a.pred as percent_actives, round(v.pred * 100, 6) as percent_view, 'prediction' as data_type "
        "from a full join v on a.match_id = v.match_id",
        **_DASH,
    ),
)
def dashboard_predicted(spark, d):
    rows = predicted_metrics(_predictions(spark, d, "F"), _predictions(spark, d, "O"), _dashboard_titles(spark, d))
    return rows.withColumn("percent_view", rnd("percent_view"))


@query(
    "dashboard_actual",
    sql(
        "fk",
        """
        select title_name, fk.match_id, days_since_first_offered, round(p, 6) as percent_actives,
            round(retail_viewed_count_percent * 100, 6) as percent_view, 'actual' as data_type
        from fk left join (select 'V' || k as match_id, day(ts) as n, sum(value) as p from ev where event_type = 'error' group by 1, 2) e
            on e.match_id = fk.match_id and e.n = days_since_first_offered
        where platform_name = 'current'""",
    ),
)
def dashboard_actual(spark, d):
    actives = s.events(spark, d, "error").groupBy(
        F.concat(F.lit("V"), F.col("k").cast("string")).alias("match_id"), F.dayofmonth("ts").alias("days_on_platform")
    ).agg(F.sum("value").alias("pct_actives"))
    rows = actual_metrics(actives, s.funnel_rows(spark, d))
    return rows.select(
        "title_name", "match_id", big("days_since_first_offered").alias("days_since_first_offered"),
        rnd("percent_actives").alias("percent_actives"), rnd("percent_view").alias("percent_view"), "data_type",
    )
