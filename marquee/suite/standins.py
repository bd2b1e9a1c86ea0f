"""Content-analytics tables derived from the given test tables.

Each builder has a SQL twin in ``CTES``; a query's SQL names the ones it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.keys import PlatformRule, season_number_adj
from marquee.plans.subscriptions import active_islands, subscription_periods, subscription_sessions
from marquee.session import stored
from marquee.sources.tables import scan

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
}

RUN_TS = "2024-01-29 12:00:00"
END_TS = "2024-01-29 00:00:00"
RULES = (
    PlatformRule(("dtc", "google", "samsung", "apple"), "2024-01-05"),
    PlatformRule(("amazon",), "2024-01-10"),
    PlatformRule(("roku",), "2024-01-15"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def launch_of(k: Column) -> Column:
    """Launch rule shared by both engines: one of 20 days and three times of day."""
    start = ts("2024-01-01 00:00:00")
    return start + F.make_dt_interval(days=(k % 20).cast("int"), hours=((k % 3) * 6).cast("int"))


def events(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    """Events with the title number ``k`` read from the property text."""
    df = table(spark, sf_dir, "events")
    if types:
        df = df.where(F.col("event_type").isin(*types))
    return df.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part table as a title catalogue; six parts in a row form a series."""
    k = F.col("p_partkey")
    series = F.col("p_type").isin("ECONOMY", "SMALL", "MEDIUM")
    number = F.floor(k / 6).cast("string")
    launch = launch_of(k)
    day = F.make_dt_interval

    def every(n: int, value: Column) -> Column:
        return F.when(k % n == 0, value)

    return table(spark, sf_dir, "part").select(
        k.alias("k"),
        F.concat(F.lit("V"), k.cast("string")).alias("viewable_id"),
        F.when(series, F.concat(F.lit("S"), number)).alias("series_id"),
        F.when(series & (k % 3 != 0), (k % 3).cast("int")).alias("season_number"),
        F.when(series, F.concat(F.lit("Show "), number)).alias("series_title_long"),
        F.col("p_name").alias("asset_title_long"),
        F.col("p_name").alias("asset_title_short"),
        F.when(series, "series").when(F.col("p_type") == "PROMO", "special").otherwise("movies").alias(
            "content_category"
        ),
        F.when(k % 11 == 10, "TRAILER").when(k % 2 == 0, "FEATURE").otherwise("ELEMENT").alias("asset_type"),
        launch.alias("first_offered_date_current"),
        every(4, launch + day(days=F.lit(3))).alias("first_offered_date_legacy"),
        every(5, launch - day(days=F.lit(30))).alias("theatrical_release_date"),
        every(6, launch - day(days=F.lit(10))).alias("original_linear_air_date"),
        every(7, launch - day(days=F.lit(400))).alias("first_offered_date_linear"),
        every(8, launch + day(days=F.lit(1))).alias("premiere_air_date"),
        F.when(k % 3 == 0, "original").when(k % 3 == 1, "acquired").alias("program_type"),
        (F.lit(2024) - F.col("p_size") % 5).cast("int").alias("release_year"),
        F.col("p_brand").alias("licensor"),
        F.when(k % 9 != 0, F.col("p_name")).alias("descriptive_genre_desc"),
        F.col("p_type").alias("wm_enterprise_genres"),
        F.element_at(F.split("p_name", " "), 1).alias("navigation_genre_desc"),
        "p_retailprice",
    )


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two edits per asset, one a minute longer."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("V"), k.cast("string")).alias("viewable_id"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("edit_id"),
        "p_retailprice",
    ).select(
        "viewable_id",
        "edit_id",
        (F.col("p_retailprice") + 60 * F.col("edit_id")).alias("credits_start_time"),
    )


def views(spark: SparkSession, sf_dir: str, event_type: str = "view") -> DataFrame:
    """Viewing stream: seconds are twenty times the event value."""
    catalogue = assets(spark, sf_dir).select(
        "viewable_id",
        "series_id",
        season_number_adj(F.col("content_category"), F.col("season_number")).alias("season_number"),
    )
    stream = events(spark, sf_dir, event_type).select(
        "event_id",
        "user_id",
        F.concat(F.lit("V"), F.col("k").cast("string")).alias("viewable_id"),
        (F.col("event_id") % 2).cast("int").alias("edit_id"),
        F.col("ts").alias("stream_at"),
        (F.col("value") * 20).alias("stream_seconds"),
    )
    return stream.join(catalogue, "viewable_id")


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups as store receipts; starts fall on midnight, so renewals line up."""
    k = F.col("k")
    start = F.date_trunc("day", "ts")

    def later(days: Column | int) -> Column:
        days = F.lit(days) if isinstance(days, int) else days
        return start + F.make_dt_interval(days=days)

    providers = F.array(
        *[F.lit(p) for p in ("dtc", "google", "samsung", "apple", "amazon", "roku", "other")]
    )
    return events(spark, sf_dir, "signup").select(
        F.lit("plan").alias("product_code"),
        F.element_at(providers, (k % 7 + 1).cast("int")).alias("provider"),
        F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("provider_user_id"),
        F.when(k % 8 == 0, "trial").otherwise("paid").alias("free_paid_ind"),
        F.when(k % 13 == 0, "TVOD").otherwise("SVOD").alias("subscription_type"),
        F.when(k % 17 == 0, "CA").otherwise("US").alias("country_code"),
        start.alias("subscription_start_date"),
        later((k % 3 + 3).cast("int")).alias("subscription_expire_date"),
        later(2).alias("subscription_cancel_date"),
        F.when(k % 5 == 0, later(5)).alias("next_start"),
        (k % 4 == 0).alias("is_cancel"),
    )


def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("P"), key.cast("string")).alias("provider_user_id"),
        F.when(key % 10 != 9, key).alias("user_id"),
    )


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subscription_periods(
        receipts(spark, sf_dir), identity(spark, sf_dir), ts(RUN_TS), RULES, ("plan",)
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subscription_sessions(periods(spark, sf_dir))


def islands(sessions_table: DataFrame, platform: str | None = None) -> DataFrame:
    """Stored, as the audience counts read them several times."""
    return stored(active_islands(sessions_table, platform))


def stored_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session table that a daily job would publish for all later ones."""
    return stored(sessions(spark, sf_dir))


def funnel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small funnel table: plays and clicks per title and day since launch."""
    seen = events(spark, sf_dir, "view", "click").withColumn("launch", launch_of(F.col("k")))
    day = F.datediff("ts", "launch")
    daily = (
        seen.where((F.col("ts") >= F.col("launch")) & day.between(0, 28))
        .groupBy("k", "launch", day.alias("days_since_first_offered"))
        .agg(
            F.sum((F.col("event_type") == "view").cast("bigint")).alias("played"),
            F.sum((F.col("event_type") == "click").cast("bigint")).alias("viewed"),
        )
    )
    titles = assets(spark, sf_dir).select("k", "viewable_id", "asset_title_long", "content_category")
    subs = F.col("played") + F.col("viewed") + 10
    rows = daily.join(titles, "k").select(
        "k",
        F.concat("asset_title_long", F.lit(" S1")).alias("title_name"),
        F.col("viewable_id").alias("match_id"),
        "content_category",
        F.when(F.col("k") % 5 == 0, "legacy").otherwise("current").alias("platform_name"),
        F.col("launch").alias("earliest_offered_timestamp"),
        (F.col("launch") + F.make_dt_interval(days=(F.col("k") % 40).cast("int"))).alias(
            "last_offered_timestamp"
        ),
        (F.col("k") % 2).cast("int").alias("single_episode_ind"),
        "days_since_first_offered",
        subs.alias("total_retail_sub_count"),
        (F.col("played") / subs).alias("retail_played_count_percent"),
        (F.col("viewed") / subs).alias("retail_viewed_count_percent"),
    )
    # a published table for everything that reads it
    return stored(rows)


# --- SQL twins -----------------------------------------------------------------

_LAUNCH = "timestamp '2024-01-01' + to_days(cast({k} % 20 as integer)) + to_hours(cast({k} % 3 * 6 as integer))"


def launch_sql(k: str) -> str:
    return _LAUNCH.format(k=k)


CTES = {
    "ev": "select *, cast(json_extract_string(props, '$.k') as bigint) as k from events",
    "assets": f"""
        select *, {launch_sql('k')} as first_offered_date_current,
            case when k % 4 = 0 then {launch_sql('k')} + interval 3 day end as first_offered_date_legacy,
            case when k % 5 = 0 then {launch_sql('k')} - interval 30 day end as theatrical_release_date,
            case when k % 6 = 0 then {launch_sql('k')} - interval 10 day end as original_linear_air_date,
            case when k % 7 = 0 then {launch_sql('k')} - interval 400 day end as first_offered_date_linear,
            case when k % 8 = 0 then {launch_sql('k')} + interval 1 day end as premiere_air_date
        from (select p_partkey as k, 'V' || p_partkey as viewable_id,
            case when p_type in ('ECONOMY', 'SMALL', 'MEDIUM') then 'S' || (p_partkey // 6) end as series_id,
            case when p_type in ('ECONOMY', 'SMALL', 'MEDIUM') and p_partkey % 3 <> 0 then p_partkey % 3 end as season_number,
            case when p_type in ('ECONOMY', 'SMALL', 'MEDIUM') then 'Show ' || (p_partkey // 6) end as series_title_long,
            p_name as asset_title_long, p_name as asset_title_short,
            case when p_type in ('ECONOMY', 'SMALL', 'MEDIUM') then 'series'
                when p_type = 'PROMO' then 'special' else 'movies' end as content_category,
            case when p_partkey % 11 = 10 then 'TRAILER' when p_partkey % 2 = 0 then 'FEATURE' else 'ELEMENT' end as asset_type,
            case when p_partkey % 3 = 0 then 'original' when p_partkey % 3 = 1 then 'acquired' end as program_type,
            2024 - p_size % 5 as release_year, p_brand as licensor,
            case when p_partkey % 9 <> 0 then p_name end as descriptive_genre_desc,
            p_type as wm_enterprise_genres, split_part(p_name, ' ', 1) as navigation_genre_desc, p_retailprice
        from part)""",
    "edits": "select 'V' || p_partkey as viewable_id, e as edit_id, p_retailprice + 60 * e as credits_start_time "
    "from part, (values (0), (1)) as t(e)",
    "asset_keys": """
        select *, case when content_category = 'series' then coalesce(season_number, 1) else season_number end as season_adj
        from assets""",
    "titles": """
        select distinct series_id, viewable_id,
            coalesce(series_title_long || ' S' || season_adj, asset_title_long) as title_name,
            coalesce(series_id || '-' || season_adj, viewable_id) as match_id,
            season_adj as season_number_adj, content_category,
            case when series_id is null then 1 else 0 end as single_episode_ind,
            first_offered_date_current as offered_at,
            case when theatrical_release_date is null and original_linear_air_date is null
                then least(first_offered_date_current, first_offered_date_legacy)
                else least(theatrical_release_date, original_linear_air_date) end as public_at
        from asset_keys where asset_type in ('FEATURE', 'ELEMENT')""",
    "launches": """
        select t.title_name, t.match_id, min(offered_at) as launch, max(offered_at) as last_offered,
            min(public_at) as earliest_public, min(season_number_adj) as season_number_adj,
            min(content_category) as content_category, min(single_episode_ind) as single_episode_ind,
            any_value(e.n) as viewable_id_count
        from titles t join (select match_id, count(distinct viewable_id) as n from titles group by 1) e using (match_id)
        group by 1, 2""",
    "views": """
        select event_id, user_id, 'V' || ev.k as viewable_id, event_id % 2 as edit_id, ts as stream_at,
            value * 20 as stream_seconds, series_id, season_adj as season_number
        from ev join asset_keys a on a.k = ev.k where event_type = 'view'""",
    "receipts": """
        select ['dtc', 'google', 'samsung', 'apple', 'amazon', 'roku', 'other'][k % 7 + 1] as provider,
            'P' || user_id as provider_user_id, k % 8 = 0 as trial,
            k % 13 <> 0 as svod, k % 17 <> 0 as us_sub,
            date_trunc('day', ts)::timestamp as s,
            date_trunc('day', ts)::timestamp + to_days(cast(k % 3 + 3 as integer)) as e,
            date_trunc('day', ts)::timestamp + interval 2 day as c,
            case when k % 5 = 0 then date_trunc('day', ts)::timestamp + interval 5 day end as nxt,
            k % 4 = 0 as is_cancel
        from ev where event_type = 'signup'""",
    "periods": f"""
        select * from (select c_custkey as user_id, provider, case when trial then 1 else 0 end as is_trial,
            case when provider in ('dtc', 'google', 'samsung', 'apple') and s >= timestamp '2024-01-05' then 'current'
                when provider = 'amazon' and s >= timestamp '2024-01-10' then 'current'
                when provider = 'roku' and s >= timestamp '2024-01-15' then 'current'
                when s < timestamp '2024-01-05' then 'legacy' end as platform_name,
            s as starts_at,
            case when not is_cancel and nxt is not null then nxt
                when provider in ('google', 'samsung')
                    and date_diff('day', e::date, date '{RUN_TS[:10]}') <= 2 then c
                else e end as ends_at
        from receipts join customer on provider_user_id = 'P' || c_custkey
        where c_custkey % 10 <> 9 and svod and us_sub and provider <> 'other')
        where platform_name is not null""",
    "sessions": """
        select user_id, provider, platform_name, is_trial, cast(session_id as bigint) as session_id,
            min(starts_at) as starts_at, max(ends_at) as ends_at
        from (select *, sum(case when starts_at = prev then 0 else 1 end) over (
                partition by user_id, provider, platform_name, is_trial order by starts_at) as session_id
            from (select *, lag(ends_at) over (partition by user_id, provider, platform_name, is_trial
                order by starts_at, ends_at) as prev from periods))
        group by 1, 2, 3, 4, 5""",
    "streams": """
        select l.title_name, l.match_id, l.launch, l.viewable_id_count, l.single_episode_ind, v.user_id,
            v.viewable_id, v.event_id, v.stream_at, v.stream_seconds / 3600 as stream_hours,
            ed.credits_start_time / 3600 as runtime_hours
        from views v join launches l on coalesce(v.series_id || '-' || v.season_number, v.viewable_id) = l.match_id
        join (select distinct viewable_id, offered_at from titles) f on f.viewable_id = v.viewable_id
        join edits ed on ed.viewable_id = v.viewable_id and ed.edit_id = v.edit_id
        where v.stream_at between l.launch and l.launch + interval 28 day and v.stream_at >= f.offered_at""",
    "base": """
        select * from streams st where exists (select 1 from sessions p where p.user_id = st.user_id
            and p.ends_at >= st.launch and p.starts_at < st.launch + interval 28 day)""",
    "days28": "select unnest(generate_series(1, 28))::integer as n",
    "funnel_rows": f"""
        select k, asset_title_long || ' S1' as title_name, viewable_id as match_id, content_category,
            case when k % 5 = 0 then 'legacy' else 'current' end as platform_name,
            launch as earliest_offered_timestamp,
            launch + to_days(cast(k % 40 as integer)) as last_offered_timestamp, k % 2 as single_episode_ind,
            n as days_since_first_offered, played + viewed + 10 as total_retail_sub_count,
            played / (played + viewed + 10) as retail_played_count_percent,
            viewed / (played + viewed + 10) as retail_viewed_count_percent
        from (select k, launch, date_diff('day', launch::date, ts::date) as n,
                count(*) filter (event_type = 'view') as played, count(*) filter (event_type = 'click') as viewed
            from (select *, {launch_sql('k')} as launch from ev where event_type in ('view', 'click'))
            where ts >= launch and date_diff('day', launch::date, ts::date) between 0 and 28 group by 1, 2, 3)
        join assets using (k)""",
    "fk": """
        select *, case when platform_name = 'legacy' then '0-' else '1-' end || match_id as match_id_platform
        from funnel_rows""",
}

_NEEDS = {
    "asset_keys": ("assets",),
    "titles": ("asset_keys",),
    "launches": ("titles",),
    "views": ("ev", "asset_keys"),
    "receipts": ("ev",),
    "periods": ("receipts",),
    "sessions": ("periods",),
    "streams": ("views", "launches", "titles", "edits"),
    "base": ("streams", "sessions"),
    "funnel_rows": ("ev", "assets"),
    "fk": ("funnel_rows",),
}


def sql(names: str, body: str, /, **extra: str) -> str:
    """``with`` clause of the named stand-ins, further CTEs, and the final select."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, ()):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    parts = [f"{n} as ({CTES[n]})" for n in ordered]
    parts += [f"{n} as ({body_})" for n, body_ in extra.items()]
    prefix = f"with {', '.join(parts)} " if parts else ""
    return prefix + body
