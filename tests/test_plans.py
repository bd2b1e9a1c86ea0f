"""Properties of the plans: shares, decay steps, trailers, and plan shapes."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from marquee.operators.intervals import merge_intervals
from marquee.plans import firstviews, hours, pageviews, trailers

T0 = datetime(2024, 1, 1)


def d(n):
    return (T0 + timedelta(days=n)).date()


def test_hours_share_against_loop(spark):
    rng = random.Random(8)
    streams = [
        (f"t{rng.randrange(6)}", T0 + timedelta(days=rng.randrange(60), hours=5), float(rng.randrange(60, 400)))
        for _ in range(300)
    ]
    offers = [(f"t{i}", d(i * 5)) for i in range(6)]
    got = {
        (r.match_id, r.window): r.hourspct
        for r in hours.hours_share(
            spark.createDataFrame(streams, "match_id string, stream_at timestamp, stream_seconds double"),
            spark.createDataFrame(offers, "match_id string, offer_date date"),
            "2024-02-20",
            windows=(7, 28),
        ).collect()
    }
    for title, offer in offers:
        for w in (7, 28):
            inside = [
                (m, sec) for m, at, sec in streams if sec >= 120 and offer <= at.date() < offer + timedelta(days=w)
            ]
            own = sum(sec for m, sec in inside if m == title)
            if own and offer + timedelta(days=w) <= datetime(2024, 2, 20).date():
                assert got[(title, w)] == pytest.approx(100 * own / sum(sec for _, sec in inside))
            else:
                assert (title, w) not in got


def test_decay_steps_sum_to_the_last_share(spark):
    rng = random.Random(1)
    rows = [(f"c{t % 2}", t, day, rng.randrange(1, 50)) for t in range(8) for day in range(10)]
    df = spark.createDataFrame(rows, "category string, title_id int, days_since_premiere int, first_views int")
    curve = firstviews.decay_curve(df, ["category", "title_id"], "category", "title_id").collect()
    for category in ("c0", "c1"):
        steps = sorted((r for r in curve if r.category == category), key=lambda r: r.days_since_premiere)
        assert sum(r.first_views_pct for r in steps) == pytest.approx(steps[-1].first_views_cumpct)
        assert steps[-1].first_views_cumpct == pytest.approx(1) and steps[0].title_count_training == 4


def test_trailer_reach_first_seen_by_day(spark):
    launch = T0 + timedelta(days=40)
    links = spark.createDataFrame(
        [("t", "m", "current", "a", launch - timedelta(days=30), launch), ("t", "m", "current", "b", launch - timedelta(days=3), launch)],
        "title_name string, match_id string, platform_name string, viewable_id string, trailer_at timestamp, launch timestamp",
    )
    views = [
        (1, "a", launch - timedelta(days=29), 20.0),  # before the window opens
        (2, "a", launch - timedelta(days=28), 20.0),  # exactly when it opens
        (3, "a", launch - timedelta(days=5), 10.0),  # too short
        (3, "b", launch - timedelta(days=2), 11.0),
        (2, "b", launch, 30.0),  # known already, exactly at launch
    ]
    periods = [(u, T0, T0 + timedelta(days=99)) for u in (1, 2, 3, 4)]
    islands = merge_intervals(
        spark.createDataFrame(periods, "user_id int, starts_at timestamp, ends_at timestamp"), ["user_id"], "starts_at", "ends_at"
    )
    rows = trailers.trailer_reach(
        spark.createDataFrame(views, "user_id int, viewable_id string, stream_at timestamp, stream_seconds double"),
        links, islands, F.lit(launch + timedelta(days=9)),
    ).collect()
    got = {r.nday_before: (r.view_count, r.total_trailer_num, r.total_retail_sub_count, r.cumulative_day_num) for r in rows}
    assert sorted(got) == list(range(-27, 1))
    assert got[-27] == (1, 1, 4, 1) and got[-3] == (1, 1, 4, 25) and got[-2] == (2, 2, 4, 26) and got[0] == (2, 2, 4, 28)


def test_page_views_skip_ambiguous_ids(spark):
    tracked = spark.createDataFrame(
        [("A", "1-a", "x1", T0), ("B", "1-b", "x2", T0), ("C", "1-c", "x2", T0), ("D", "1-d", "x3", T0), ("D", "1-d", "x4", T0)],
        "title_name string, match_id_platform string, outside_id string, launch timestamp",
    )
    ids = spark.createDataFrame([(f"x{i}", f"p{i}") for i in range(1, 5)], "outside_id string, article string")
    views = spark.createDataFrame(
        [("p1", "2023-10-29", 5), ("p1", "2023-10-28", 7), ("p1", "2024-01-29", 2), ("p1", "2024-01-30", 9), ("p2", "2024-01-01", 1), ("p3", "2024-01-01", 1)],
        "article string, date string, page_views int",
    )
    got = {r.days_since_first_offered: r.total_page_views for r in pageviews.page_view_table(views, ids, tracked).collect()}
    assert got == {-64: 5, 28: 2}


HEAVY = ("launch_audience", "trailer_reach", "cumulative_actives", "hours_share", "calendar_grid", "pageview_table")


@pytest.mark.parametrize("name", HEAVY)
def test_no_cross_product_without_broadcasts(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = entry.queries()[name](spark, "/root/testdata/sf0.001")
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_scan_reads_two_columns_and_pushes_the_filter(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    frame = entry.queries()["scan_pruned"](spark, "/root/testdata/sf0.001")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "EqualTo(l_returnflag,R)" in plan
    assert "l_extendedprice" not in plan


def test_reference_graph_removes_repeats_before_the_hops_meet(spark):
    """Unknown references fall together, every row comes once, and no distinct runs over the product."""
    titles = spark.createDataFrame([(1, "A"), (1, "A"), (2, "B"), (3, "C")], "title_ref long, title_name string")
    names = spark.createDataFrame([(1, "a"), (2, "b"), (5, "e")], "title_ref long, original_title string")
    links = spark.createDataFrame(
        [(1, "follows", 2), (1, "follows", 2), (1, "follows", 8), (1, "follows", 9), (2, "featured_in", 5), (2, "featured_in", 7), (2, "featured_in", 6), (3, "follows", 2)],
        "title_ref long, reference_type string, reference_ref long",
    )
    graph = firstviews.reference_graph(titles, names, links)
    pick = lambda r: (r.title_ref, r.reference_type, r.reference_title_id, r.reference_reference_type, r.reference_reference_title_id)
    b = [(1, "follows", 2, "featured_in", 5), (1, "follows", 2, "featured_in", None), (1, "follows", None, None, None)]
    b += [(2, "featured_in", 5, None, None), (2, "featured_in", None, None, None)]
    assert sorted(map(pick, graph.collect()), key=str) == sorted(b, key=str)
    linked = firstviews.reference_graph(titles, names, links, keep_unlinked=True)
    assert {(3, "follows", 2, "featured_in", 5)} < set(map(pick, linked.collect())) and linked.count() == 7
    top = graph._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in top[: top.index("Join")]


def test_reference_graph_is_dealt_by_the_size_of_its_links(spark, tmp_path):
    """However few shuffle partitions are set, larger links come in more parts, and rows whose
    reference is unknown do not fall into one."""
    names = spark.range(4000).select(F.col("id").alias("title_ref"), F.format_string("n%d", "id").alias("original_title"))
    titles = names.select("title_ref", F.lit("t").alias("title_name"))
    unknown = (F.col("id") % 2 * 1_000_000 + F.col("id") % 4000).alias("reference_ref")
    links = spark.range(1_000_000).select(
        (F.col("id") % 4000).alias("title_ref"), F.lit("follows").alias("reference_type"), unknown, F.sha2(F.col("id").cast("string"), 512).alias("note")
    )
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        links.limit(1000).write.parquet(f"{tmp_path}/small")
        links.write.parquet(f"{tmp_path}/large")
        small = firstviews.reference_graph(titles, names, spark.read.parquet(f"{tmp_path}/small"))
        graph = firstviews.reference_graph(titles, names, spark.read.parquet(f"{tmp_path}/large"))
        assert small.rdd.getNumPartitions() == 2 and graph.rdd.getNumPartitions() >= 6
        sizes = [r["count"] for r in graph.where("reference_title_id is null").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sum(sizes) == 2000 and max(sizes) < 700


def test_first_views_are_dealt_by_size(spark, tmp_path):
    """However few shuffle partitions are set, calendar, decay and reference counts of larger tables come in more parts."""
    day = lambda n: F.date_add(F.lit("2024-01-02").cast("date"), n)
    assets = spark.range(60_000).select(
        F.col("id").alias("title_id"), F.sha2(F.col("id").cast("string"), 512).alias("title_name"), F.lit(1).alias("season_number"),
        F.lit("movies").alias("content_category"), F.lit("Pay1").alias("category"), F.lit(1).alias("tier"), F.col("id").alias("viewable_id"),
        day(0).alias("asset_premiere"), day(0).alias("season_premiere"), F.lit(60.0).alias("run_time"), day(0).alias("effective_start_date"), day(1).alias("effective_end_date"),
    )
    assets.write.parquet(f"{tmp_path}/assets")
    assets = spark.read.parquet(f"{tmp_path}/assets")
    edges = spark.range(300_000).select(
        F.sha2(F.col("id").cast("string"), 512).alias("title_name"), F.lit(1).alias("season_number"), F.lit("movies").alias("content_category"),
        F.lit("follows").alias("reference_type"), F.col("id").alias("reference_title_id"),
        F.lit("featured_in").alias("reference_reference_type"), F.col("id").alias("reference_reference_title_id"),
    )
    edges.write.parquet(f"{tmp_path}/graph")
    graph = spark.read.parquet(f"{tmp_path}/graph")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        views = spark.createDataFrame([], assets.select(*firstviews.TITLE, F.col("asset_premiere").alias("request_date"), F.lit(1).alias("first_views")).schema)
        calendar = firstviews.daily_grid(assets, views, views.withColumnRenamed("first_views", "hours_viewed"), "2024-01-28", "2024-12-31")
        wide = calendar._jdf.queryExecution().executedPlan().toString()
        plan = firstviews.reference_features(graph, ["title_name", "season_number", "content_category"])._jdf.queryExecution().executedPlan().toString()
        rows = calendar.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    parts = lambda text: [int(n) for n in re.findall(r"hashpartitioning\(.*?, (\d+)\), REPARTITION_BY_NUM", text)]
    assert len(parts(wide)) == 2 and min(parts(wide)) >= 8 and rows == 120_000
    assert parts(plan) and min(parts(plan)) >= 3
