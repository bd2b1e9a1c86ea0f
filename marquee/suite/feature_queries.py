"""Feature extracts, encodings and day signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.constants import FUNNEL_DAYS, NOT_REACHED
from marquee.functions import text as t
from marquee.operators.aggregates import percentiles_per_key
from marquee.operators.joins import merge_features
from marquee.operators.pivots import common_labels, label_codes, one_hot
from marquee.plans import features, pageviews
from marquee.plans.neighbors import trend_features, trend_neighbours
from marquee.session import stored
from marquee.suite import standins as s
from marquee.suite.audience_queries import PAGEVIEWS, page_titles, page_view_rows
from marquee.suite.registry import big, query, rnd, us
from marquee.suite.standins import launch_sql, sql

KEY = features.KEY


def _days_sql(value: str, suffix: str, days=FUNNEL_DAYS) -> str:
    return ", ".join(
        f"round(max({value}) filter (days_since_first_offered = {n}), 6) as day{n:03d}_{suffix}" for n in days
    )


def _rounded(df, digits=6):
    return df.select(*[rnd(c, digits).alias(c) if t_ == "double" else F.col(c) for c, t_ in df.dtypes])


@query(
    "day_pivot",
    sql(
        "fk",
        f"select match_id_platform, {_days_sql('retail_viewed_count_percent', 'percent_viewed')}, "
        "cast(max(days_since_first_offered) as bigint) as max_day from fk group by 1",
    ),
)
def day_pivot(spark, d):
    wide = features.percent_viewed_feature(s.funnel_rows(spark, d))
    return _rounded(
        wide.withColumn("max_day", big("max_days_since_first_offered")).drop("max_days_since_first_offered")
    )


@query(
    "sub_count_pivot",
    sql("fk", f"select match_id_platform, {_days_sql('total_retail_sub_count', 'sub_count')} from fk group by 1"),
)
def sub_count_pivot(spark, d):
    return features.sub_count_feature(s.funnel_rows(spark, d))


@query(
    "viewed_through_pivot",
    sql(
        "fk",
        "select match_id_platform, "
        + _days_sql(
            "case when retail_played_count_percent > 0 then retail_viewed_count_percent / retail_played_count_percent else 0 end",
            "vtp",
        )
        + " from fk group by 1",
    ),
)
def viewed_through_pivot(spark, d):
    return _rounded(features.viewed_through_feature(s.funnel_rows(spark, d)))


# --- marketing cost: purchases as spend on the title's first word -----------------------

_SPEND = """
    select case when k % 7 = 0 then 'FLIGHT ATTENDANT' when k % 7 = 1 then '-' else upper(p_name) end as campaign,
        p_name as detail, case when k % 2 = 0 then 'NEW' else 'OLD' end as product,
        case when k % 23 = 0 then 'x' end as tag, ts as day, value as media_cost
    from ev join part on p_partkey = k where event_type = 'purchase'"""
_ADS = """
    select distinct case when campaign = '-' then detail when campaign = 'FLIGHT ATTENDANT' then 'the flight attendant'
        else campaign end as campaign, day::date as day, media_cost, product from spend where tag is null"""
_AD_PLATFORM = """
    select lower(campaign) as name, day, media_cost,
        case when product = 'NEW' or day >= date '2024-01-15' then 'current' else 'legacy' end as platform_name from ads0"""
_COST = {
    "spend": _SPEND,
    "ads0": _ADS,
    "ads": _AD_PLATFORM,
    "tt": """
        select distinct title_name, platform_name, match_id_platform, earliest_offered_timestamp as launch from fk""",
    "daily": """
        select match_id_platform, date_diff('day', launch::date, day) as n, sum(media_cost) as spend
        from tt join ads on name = lower(split_part(title_name, ' S', 1)) and ads.platform_name = tt.platform_name
        where day::timestamp >= launch group by 1, 2""",
    "curve": """
        select match_id_platform, n, sum(spend) over (partition by match_id_platform order by n) as c
        from (select distinct match_id_platform, days_since_first_offered as n from fk) left join daily using (match_id_platform, n)""",
}


def _campaigns(spark, d):
    part = s.table(spark, d, "part").select(F.col("p_partkey").alias("k"), "p_name")
    k = F.col("k")
    spend = s.events(spark, d, "purchase").join(part, "k").select(
        F.when(k % 7 == 0, "FLIGHT ATTENDANT").when(k % 7 == 1, "-").otherwise(F.upper("p_name")).alias("campaign"),
        F.col("p_name").alias("detail"),
        F.when(k % 2 == 0, "NEW").otherwise("OLD").alias("product"),
        F.when(k % 23 == 0, "x").alias("tag"),
        F.col("ts").alias("day"),
        F.col("value").alias("media_cost"),
    )
    return features.clean_campaigns(spend, ("NEW", "OLD"))


@query(
    "media_cost_curve",
    sql(
        "fk",
        "select match_id_platform, n, round(case when c is null or c < 0 then -1 else ln(c + 1) end, 6) "
        "as ln_cum_total_media_cost from curve",
        **_COST,
    ),
)
def media_cost_curve(spark, d):
    rows = features.media_cost_curve(
        s.funnel_rows(spark, d), _campaigns(spark, d), "NEW", since="2024-01-15"
    )
    return rows.select(KEY, big("n").alias("n"), rnd("ln_cum_total_media_cost").alias("ln_cum_total_media_cost"))


@query(
    "media_cost_pivot",
    sql(
        "fk",
        "select match_id_platform, "
        + ", ".join(
            f"round(max(case when c is null or c < 0 then -1 else ln(c + 1) end) filter (n = {n}), 6) as day{n:03d}_mc"
            for n in FUNNEL_DAYS
        )
        + " from curve group by 1",
        **_COST,
    ),
)
def media_cost_pivot(spark, d):
    rows = features.media_cost_curve(s.funnel_rows(spark, d), _campaigns(spark, d), "NEW", since="2024-01-15")
    return _rounded(features.media_cost_feature(rows))


@query(
    "prelaunch_cost",
    sql(
        "fk",
        """
        select match_id_platform, round(coalesce(max(ln_cost), -1), 6) as ln_total_media_cost_pre_launch
        from tt left join (select match_id_platform, name, ln(sum(media_cost + 1)) as ln_cost
            from tt join ads on name = lower(split_part(title_name, ' S', 1)) and ads.platform_name = tt.platform_name
            where day::timestamp between launch - interval 56 day and launch - interval 1 minute group by 1, 2)
            using (match_id_platform) group by 1""",
        **{n: _COST[n] for n in ("spend", "ads0", "ads", "tt")},
    ),
)
def prelaunch_cost(spark, d):
    rows = features.prelaunch_cost(s.funnel_rows(spark, d), _campaigns(spark, d), "NEW", since="2024-01-15")
    return _rounded(rows)


# --- metadata -------------------------------------------------------------------------------

_META = {
    "meta_rows": """
        select distinct a.viewable_id, coalesce(series_id || '-' || season_adj, a.viewable_id) as match_id,
            case when content_category = 'series' then coalesce(season_number, 1) else coalesce(season_number, -1) end as season_number_adj,
            coalesce(program_type, 'unknown') as program_type, content_category, r.run, release_year, licensor,
            descriptive_genre_desc, wm_enterprise_genres, navigation_genre_desc,
            coalesce(least(first_offered_date_linear, original_linear_air_date, theatrical_release_date,
                first_offered_date_current, first_offered_date_legacy, premiere_air_date), timestamp '2120-05-27') as public_at
        from asset_keys a left join (select viewable_id, avg(credits_start_time) as run from edits group by 1) r using (viewable_id)""",
    "modes": """
        select match_id, season_number_adj,
            first(program_type order by n desc, program_type) as program_type
        from (select match_id, season_number_adj, program_type, count(*) as n from meta_rows group by 1, 2, 3) group by 1, 2""",
    "meta": """
        select match_id, season_number_adj, coalesce(sum(run) / 3600, -1) as total_hours, min(release_year) as prod_release_year,
            coalesce(string_agg(distinct lower(licensor), '|' order by lower(licensor)), '') as licensor_agg,
            coalesce(string_agg(distinct lower(descriptive_genre_desc), '|' order by lower(descriptive_genre_desc)), '') as genre_agg,
            coalesce(string_agg(distinct lower(wm_enterprise_genres), '|' order by lower(wm_enterprise_genres)), '') as wm_agg,
            min(public_at) as public_at, min(content_category) as content_category
        from meta_rows group by 1, 2""",
}


def _metadata(spark, d):
    return features.metadata_by_title(s.assets(spark, d), s.edits(spark, d))


@query(
    "metadata_rollup",
    sql(
        "asset_keys edits",
        """
        select match_id, season_number_adj, program_type, content_category, round(total_hours, 6) as total_hours,
            prod_release_year, licensor_agg, genre_agg, wm_agg, epoch_us(public_at) as public_us
        from meta join modes using (match_id, season_number_adj)""",
        **_META,
    ),
    wide=("season_number_adj",),
)
def metadata_rollup(spark, d):
    return _metadata(spark, d).select(
        "match_id", "season_number_adj", "program_type", "content_category", rnd("total_hours").alias("total_hours"),
        "prod_release_year", "licensor_agg", F.col("descriptive_genre_desc_agg").alias("genre_agg"),
        F.col("wm_enterprise_genres_agg").alias("wm_agg"), us("earliest_public_timestamp").alias("public_us"),
    )


@query(
    "metadata_feature",
    sql(
        "asset_keys edits fk",
        """
        select distinct title_name, match_id, match_id_platform, season_number_adj,
            case when platform_name = 'legacy' then 0 else 1 end as platform_name, single_episode_ind,
            case when earliest_offered_timestamp + interval 28 day <= last_offered_timestamp then 1 else 0 end as in_sequantial_releasing_period,
            case when year(earliest_offered_timestamp) = prod_release_year then 1 else 0 end as at_release_year,
            dayofweek(earliest_offered_timestamp) as dayofweek_earliest_date,
            round(case when date_diff('day', public_at::date, earliest_offered_timestamp::date) / 365.0 + 1
                    < year(earliest_offered_timestamp) - prod_release_year then year(earliest_offered_timestamp) - prod_release_year
                else date_diff('day', public_at::date, earliest_offered_timestamp::date) / 365.0 end, 6)::double as title_age_approx
        from meta join fk using (match_id)""",
        **_META,
    ),
    wide=("season_number_adj", "single_episode_ind", "dayofweek_earliest_date"),
)
def metadata_feature(spark, d):
    rows = features.metadata_feature(_metadata(spark, d), s.funnel_rows(spark, d))
    return rows.select(
        "title_name", "match_id", KEY, "season_number_adj", "platform_name", "single_episode_ind",
        "in_sequantial_releasing_period", "at_release_year", "dayofweek_earliest_date",
        rnd("title_age_approx").alias("title_age_approx"),
    )


@query(
    "cost_features",
    """
    with cost as (select case when l_returnflag = 'A' then 'S' || (l_partkey // 10) || '-' || right(l_partkey::varchar, 1)
                else 'V' || l_partkey end as match_id, l_extendedprice / 1000000 as cost from lineitem),
        title as (select case when p_partkey % 5 = 0 then '0-' else '1-' end || m as match_id_platform, m as match_id
            from (select p_partkey, case when p_size % 2 = 0 then 'S' || (p_partkey // 10) || '-' || (p_partkey % 10)
                else 'V' || p_partkey end as m from part))
    select match_id_platform, round(coalesce(max(cost), -1), 6) as content_cost
    from title left join cost using (match_id) group by 1
    """,
)
def cost_features(spark, d):
    k, p = F.col("l_partkey"), F.col("p_partkey")
    series = F.col("l_returnflag") == "A"
    costs = s.table(spark, d, "lineitem").select(
        F.when(series, F.concat(F.lit("S"), F.floor(k / 10).cast("string")))
        .otherwise(F.concat(F.lit("V"), k.cast("string")))
        .alias("title_id"),
        F.when(series, "series").otherwise("movies").alias("content_category"),
        k.cast("string").alias("season_or_movie_title"),
        F.col("l_extendedprice").alias("total_cost"),
    )
    season = F.concat(F.lit("S"), F.floor(p / 10).cast("string"), F.lit("-"), (p % 10).cast("string"))
    titles = s.table(spark, d, "part").select(
        F.when(F.col("p_size") % 2 == 0, season).otherwise(F.concat(F.lit("V"), p.cast("string"))).alias("match_id"),
        F.when(p % 5 == 0, "legacy").otherwise("current").alias("platform_name"),
    )
    return _rounded(features.content_cost(costs, titles))


@query(
    "production_budget",
    sql(
        "asset_keys fk",
        """
        select match_id_platform, round(coalesce(b, -1), 6) as total_production_budget_imdb
        from (select distinct match_id, match_id_platform from fk) left join (
            select match_id, sum(budget) as b from (
                select coalesce(series_id || '-' || season_adj, viewable_id) as match_id, viewable_id, max(o_totalprice / 1000000) as budget
                from orders join asset_keys on k = o_custkey // 2
                where asset_type in ('FEATURE', 'ELEMENT') group by 1, 2) group by 1) using (match_id)""",
    ),
)
def production_budget(spark, d):
    budgets = s.table(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("title_ref"), F.col("o_totalprice").alias("amount")
    )
    catalog = s.table(spark, d, "customer").select(
        F.concat(F.lit("V"), F.floor(F.col("c_custkey") / 2).cast("string")).alias("viewable_id"),
        F.col("c_custkey").cast("string").alias("title_ref"),
    )
    rows = features.production_budget(budgets, catalog, s.assets(spark, d), s.funnel_rows(spark, d))
    return _rounded(rows)


# --- trailers -------------------------------------------------------------------------------

_TR = {
    "tr": f"""
        select case when k % 5 = 0 then '0-V' else '1-V' end || k as match_id_platform,
            date_diff('day', ({launch_sql('k')} + interval 9 day)::date, ts::date) as nday_before,
            count(*)::integer as cumulative_day_num, count(distinct user_id)::integer as total_trailer_num,
            sum(value) as metric
        from ev where event_type = 'error' group by 1, 2""",
    "keys": "select distinct match_id_platform from fk",
}


def _trailers(spark, d):
    k = F.col("k")
    day = F.datediff("ts", s.launch_of(k) + F.make_dt_interval(days=F.lit(9)))
    return s.events(spark, d, "error").groupBy(
        F.concat(F.when(k % 5 == 0, "0-V").otherwise("1-V"), k.cast("string")).alias(KEY), day.alias("nday_before")
    ).agg(
        F.count(F.lit(1)).alias("cumulative_day_num"),
        F.countDistinct("user_id").alias("total_trailer_num"),
        F.sum("value").alias("retail_trailer_view_metric"),
    )


@query(
    "latest_trailer",
    sql(
        "ev fk",
        """
        select match_id_platform, coalesce(cumulative_day_num, -1)::double as cumulative_day_num,
            coalesce(total_trailer_num, -1)::double as total_trailer_num, round(coalesce(metric, -1), 4) as retail_trailer_view_metric,
            round(coalesce(metric / cumulative_day_num, -1), 6) as avg_trail_metric_per_day
        from keys left join (select * from (select *, row_number() over (partition by match_id_platform
            order by nday_before desc) as r from tr where nday_before <= 0) where r = 1) using (match_id_platform)""",
        **_TR,
    ),
)
def latest_trailer(spark, d):
    rows = features.latest_trailer_feature(_trailers(spark, d).where("nday_before <= 0"), s.funnel_rows(spark, d))
    return rows.select(
        KEY, "cumulative_day_num", "total_trailer_num", rnd("retail_trailer_view_metric", 4).alias("retail_trailer_view_metric"),
        rnd("avg_trail_metric_per_day").alias("avg_trail_metric_per_day"),
    )


@query(
    "early_trailer",
    sql(
        "ev fk",
        """
        select match_id_platform, coalesce(cumulative_day_num, -1)::double as trailer_metric_before28_cumday,
            round(coalesce(metric, -1), 4) as trailer_metric_before28
        from keys left join (select * from (select *, row_number() over (partition by match_id_platform
            order by nday_before desc) as r from tr where nday_before < -5) where r = 1) using (match_id_platform)""",
        **_TR,
    ),
)
def early_trailer(spark, d):
    early = _trailers(spark, d).where("nday_before < -5").withColumnRenamed("nday_before", "last_update_timestamp")
    rows = features.early_trailer_feature(early, s.funnel_rows(spark, d))
    return rows.select(
        KEY, "trailer_metric_before28_cumday", rnd("trailer_metric_before28", 4).alias("trailer_metric_before28")
    )


@query(
    "prelaunch_trailer_pivot",
    sql(
        "ev fk",
        "select match_id_platform, "
        + ", ".join(
            f"round(coalesce(max(metric) filter (nday_before = -{n}), -1), 4) as day{n:03d}_trailer_metric_d28" for n in range(28)
        )
        + " from keys left join tr using (match_id_platform) group by 1",
        **_TR,
    ),
)
def prelaunch_trailer_pivot(spark, d):
    return _rounded(features.prelaunch_trailer_feature(_trailers(spark, d), s.funnel_rows(spark, d)), 4)


# --- day signals ----------------------------------------------------------------------------

_GRID = {
    "mx": "select match_id_platform, least(max(days_since_first_offered), 20 + any_value(k) % 9) as max_day from fk group by 1",
    "g": """
        select match_id_platform, max_day, n, retail_viewed_count_percent as v
        from mx join (select unnest(generate_series(1, 28)) as n) on true
        left join (select match_id_platform, days_since_first_offered as n, retail_viewed_count_percent from fk) using (match_id_platform, n)""",
    "cleaned": "select match_id_platform, n, case when n > max_day then -100 when coalesce(v, 0) <= 1e-10 then 1e-10 else v end as v from g",
    "lg": """
        select match_id_platform, n, v, case when v > 0 then ln(v) else -100 end as log_value,
            case when v > 0 and max(v) filter (n = 1) over (partition by match_id_platform) > 0
                then ln(v / max(v) filter (n = 1) over (partition by match_id_platform)) else -100 end as log_ratio
        from cleaned""",
}


def _cleaned(spark, d):
    rows = features.titles_of(s.funnel_rows(spark, d))
    titles = rows.groupBy(KEY).agg(
        F.least(F.max("days_since_first_offered"), F.max(F.col("k") % 9) + 20).alias("max_day")
    )
    signal = rows.select(
        KEY, F.col("days_since_first_offered").alias("day"), F.col("retail_viewed_count_percent").alias("v")
    )
    return features.clean_day_values(features.day_grid(signal, titles, FUNNEL_DAYS), "v")


@query(
    "day_matrix_cleanup",
    sql("fk", "select match_id_platform, n as day, round(v, 12) as v from cleaned", **_GRID),
)
def day_matrix_cleanup(spark, d):
    return _cleaned(spark, d).select(KEY, big("day").alias("day"), rnd("v", 12).alias("v"))


@query(
    "log_features",
    sql(
        "fk",
        "select match_id_platform, n as day, round(log_value, 6) as log_value, round(log_ratio, 6) as log_ratio from lg",
        **_GRID,
    ),
)
def log_features(spark, d):
    rows = features.log_features(_cleaned(spark, d), "v")
    return rows.select(KEY, big("day").alias("day"), rnd("log_value").alias("log_value"), rnd("log_ratio").alias("log_ratio"))


def _assembled(spark, d):
    logs = features.log_features(_cleaned(spark, d), "v")
    long = logs.select(KEY, "day", F.lit("percent_viewed").alias("metric"), F.col("log_ratio").alias("value")).unionByName(
        logs.select(KEY, "day", F.lit("log_percent").alias("metric"), F.col("log_value").alias("value"))
    )
    wide = features.assemble(long, ["percent_viewed", "log_percent"], 14)
    flags = features.titles_of(s.funnel_rows(spark, d)).select(
        KEY, F.when(F.col("platform_name") == "legacy", 0).otherwise(1).alias("platform_name"), "k"
    ).distinct()
    target = F.when(F.col("k") % 3 == 0, F.lit(NOT_REACHED)).otherwise(F.col("day014_percent_viewed"))
    return merge_features([wide, flags], KEY).withColumn("target", target)


_WIDE = "select match_id_platform, " + ", ".join(
    f"max(log_ratio) filter (n = {n}) as day{n:03d}_percent_viewed, max(log_value) filter (n = {n}) as day{n:03d}_log_percent"
    for n in range(1, 15)
) + " from lg group by 1"
_WIDE_OUT = ", ".join(
    f"round(day{n:03d}_percent_viewed, 6) as day{n:03d}_percent_viewed, round(day{n:03d}_log_percent, 6) as day{n:03d}_log_percent"
    for n in range(1, 15)
)


@query(
    "feature_assembly",
    sql("fk", f"select match_id_platform, {_WIDE_OUT} from wide", **_GRID, wide=_WIDE),
)
def feature_assembly(spark, d):
    return _rounded(_assembled(spark, d).drop("platform_name", "target", "k"))


_SPLIT = {
    **_GRID,
    "wide": _WIDE,
    "tagged": """
        select wide.*, p, case when k % 3 = 0 then -100 else day014_percent_viewed end as target from wide
        join (select distinct match_id_platform, case when platform_name = 'legacy' then 0 else 1 end as p, k from fk) using (match_id_platform)""",
}


@query(
    "train_score_split",
    sql(
        "fk",
        """
        select match_id_platform, 'train' as part from tagged where target <> -100
        union all select match_id_platform, 'score' from tagged where target = -100 and p = 1 and """
        + " and ".join(f"day{n:03d}_percent_viewed <> -100" for n in range(1, 15)),
        **_SPLIT,
    ),
)
def train_score_split(spark, d):
    rows = _assembled(spark, d)
    train, score = features.train_and_score(rows, "target", "platform_name")
    score = features.fully_observed(score, [f"day{n:03d}_percent_viewed" for n in range(1, 15)])
    return train.select(KEY, F.lit("train").alias("part")).unionByName(score.select(KEY, F.lit("score").alias("part")))


@query(
    "observed_until",
    sql("fk", "select match_id_platform, cast(max_day as bigint) as last_day from mx where max_day = 24", mx=_GRID["mx"]),
)
def observed_until(spark, d):
    rows = features.observed_until(_cleaned(spark, d), "v", 24, 21)
    return rows.select(KEY, big("last_day").alias("last_day"))


_BACK = f"""
    select 'V' || k as match_id_platform, date_diff('day', ts::date, ({launch_sql('k')} + interval 9 day)::date) as day,
        count(*) - 1 as v, (count(*) + k % 40) as days
    from ev where event_type = 'click' group by k, 1, 2 having day between 0 and 27"""


def _back(spark, d):
    k = F.col("k")
    day = F.datediff(s.launch_of(k) + F.make_dt_interval(days=F.lit(9)), "ts")
    return s.events(spark, d, "click").groupBy(
        F.concat(F.lit("V"), k.cast("string")).alias(KEY), day.alias("day"), "k"
    ).agg((F.count(F.lit(1)) - 1).cast("double").alias("v")).where("day between 0 and 27").withColumn(
        "days", (F.col("v") + 1 + F.col("k") % 40).cast("bigint")
    )


@query(
    "latest_signal",
    sql(
        "ev",
        "select match_id_platform, min(day) as signal_day, round(ln(first(v order by day) + 1e-10), 6) as selected "
        "from back where day >= 5 group by 1",
        back=_BACK,
    ),
)
def latest_signal(spark, d):
    rows = features.latest_signal(_back(spark, d), "v", 5)
    return rows.select(KEY, big("signal_day").alias("signal_day"), rnd("selected").alias("selected"))


@query(
    "signal_days",
    sql(
        "ev",
        "select match_id_platform, 28 - max(day) + greatest(max(days) - 28, 0) as cumulative_days "
        "from back where day >= 3 group by 1",
        back=_BACK,
    ),
)
def signal_days(spark, d):
    return features.signal_days(_back(spark, d), "v", "days", 3).select(KEY, big("cumulative_days").alias("cumulative_days"))


@query(
    "popularity_filter",
    sql(
        "fk",
        """
        select match_id_platform, round(v, 6) as v from one
        where v = -100 or v >= (select quantile_cont(v, 0.8) from one)""",
        one="select match_id_platform, coalesce(max(retail_viewed_count_percent) filter (days_since_first_offered = 1), -100) as v from fk group by 1",
    ),
)
def popularity_filter(spark, d):
    rows = features.titles_of(s.funnel_rows(spark, d)).groupBy(KEY).agg(
        F.coalesce(
            F.max(F.when(F.col("days_since_first_offered") == 1, F.col("retail_viewed_count_percent"))),
            F.lit(NOT_REACHED),
        ).alias("v")
    )
    rows = stored(rows)
    threshold = percentiles_per_key(rows, [], "v", {"threshold": 0.8})
    return _rounded(features.popular_titles(rows, "v", threshold))


_CHOSEN = features.FeatureChoice(7)


@query(
    "feature_choice",
    sql(
        "fk",
        "select match_id_platform, "
        + ", ".join(
            [f"round(max(log_ratio) filter (n = {n}), 6) as day{n:03d}_log_ratio_percent_viewed" for n in range(2, 8)]
            + [f"round(max(log_value) filter (n = {n}), 6) as day{n:03d}_log_percent_viewed" for n in range(1, 8)]
        )
        + " from lg group by 1",
        **_GRID,
    ),
)
def feature_choice(spark, d):
    logs = features.log_features(_cleaned(spark, d), "v")
    long = logs.select(KEY, "day", F.lit("log_ratio_percent_viewed").alias("metric"), F.col("log_ratio").alias("value"))
    long = long.unionByName(
        logs.select(KEY, "day", F.lit("log_percent_viewed").alias("metric"), F.col("log_value").alias("value"))
    )
    return _rounded(features.assemble_chosen(long, _CHOSEN, ["percent_viewed"]))


@query(
    "signal_filter",
    sql(
        "ev",
        """
        select k, 'any' as rule from sig where a > -1 or b > -1
        union all select k, 'all' from sig where a <> -1 and b <> -1
        union all select k, 'original' from sig where k % 3 = 1""",
        sig="select k, coalesce(max(value) filter (event_type = 'click' and value > 150), -1) as a, "
        "coalesce(max(value) filter (event_type = 'view' and value > 150), -1) as b from ev group by 1",
    ),
)
def signal_filter(spark, d):
    def strongest(kind):
        hit = (F.col("event_type") == kind) & (F.col("value") > 150)
        return F.coalesce(F.max(F.when(hit, F.col("value"))), F.lit(-1.0))

    rows = stored(
        s.events(spark, d).groupBy("k").agg(strongest("click").alias("a"), strongest("view").alias("b"))
    ).withColumn("program_type", (F.col("k") % 3).cast("int"))
    parts = {
        "any": features.with_signal(rows, ["a", "b"]),
        "all": features.with_signal(rows, ["a", "b"], all_of_them=True),
        "original": features.originals(rows),
    }
    tagged = [p.select("k", F.lit(name).alias("rule")) for name, p in parts.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query(
    "actives_pivot",
    sql(
        "ev",
        "select match_id_platform, "
        + ", ".join(f"round(avg(value) filter (n = {n}), 6) as day{n:03d}_percent_actives" for n in FUNNEL_DAYS)
        + " from (select '1-V' || k as match_id_platform, day(ts) as n, value from ev where event_type = 'view') group by 1",
    ),
)
def actives_pivot(spark, d):
    title = F.concat(F.lit("V"), F.col("k").cast("string"))
    seen = s.events(spark, d, "view").select(
        title.alias("match_id"), F.dayofmonth("ts").alias("days_on_platform"), F.col("value").alias("pct_actives")
    )
    known = s.assets(spark, d).select(
        F.col("viewable_id").alias("match_id"), F.concat(F.lit("1-"), "viewable_id").alias(KEY)
    )
    return _rounded(features.percent_actives_feature(seen, known))


@query(
    "signal_totals",
    sql(
        "ev",
        """
        select b.match_id_platform, round(case when d0 + early = -1 then -1 else ln(d0 + early + 1) end, 6) as wiki_prelaunch_total
        from (select t.match_id_platform, coalesce(sum(total_page_views) filter (n < -3), -1)::double as early
            from (select distinct match_id_platform from titles0) t left join pv using (match_id_platform) group by 1) b
        join (select t.match_id_platform, coalesce(max(c), -1)::double as d0 from (select distinct match_id_platform from titles0) t
            left join (select match_id_platform, n, sum(total_page_views) over (partition by match_id_platform order by n) as c
                from pv where n between -27 and 0) c on c.match_id_platform = t.match_id_platform and n = 0 group by 1) z
            using (match_id_platform) where d0 + early > -1 or d0 + early = -1""",
        **PAGEVIEWS,
    ),
)
def signal_totals(spark, d):
    table = stored(page_view_rows(spark, d))
    titles = page_titles(spark, d)
    early = pageviews.views_before(
        table.withColumn("days_since_first_offered", F.col("days_since_first_offered") - 24), titles
    )
    rows = pageviews.cumulative_views_before(table, titles).select(KEY, "day000_wiki_d28").join(early, KEY)
    total = F.col("day000_wiki_d28") + F.col("wiki_befored28_total")
    return _rounded(features.page_view_totals(rows.where(total >= -1)).select(KEY, "wiki_prelaunch_total"))


# --- encodings ------------------------------------------------------------------------------


@query(
    "rare_filter",
    """
    with w as (select p_partkey, unnest(list_distinct(string_split(p_name || ' ' || p_brand, ' '))) as token from part)
    select token, count(*) as n_rows from w where token <> 'bolt' group by 1
    having count(*) >= 0.05 * (select count(*) from part)
    """,
)
def rare_filter(spark, d):
    words = t.tokens(F.concat_ws(" ", "p_name", "p_brand"), " ")
    return common_labels(s.table(spark, d, "part"), words, 0.05, ["bolt"])


@query(
    "label_encode",
    "select source, dense_rank() over (order by source) - 1 as code from (select distinct source from documents)",
)
def label_encode(spark, d):
    return label_codes(s.table(spark, d, "documents"), "source").select("source", big("code").alias("code"))


@query(
    "one_hot",
    "select doc_id, "
    + ", ".join(f"case when lang in ('en', 'fr', 'de') then (lang = '{v}')::integer end as lang_{v}" for v in ("en", "fr", "de"))
    + " from documents",
)
def one_hot_lang(spark, d):
    return s.table(spark, d, "documents").select("doc_id", *one_hot(F.col("lang"), ("en", "fr", "de"), "lang_"))


@query(
    "text_genres",
    """
    with g as (select p_partkey, lower(p_name || case when p_partkey % 3 = 0 then ' & sports/historical' else ':originals' end
            || '|' || case when p_partkey % 5 = 0 then 'romantic comedy' else 'documentaries' end || '|' || p_type) as t from part),
        c as (select p_partkey, replace(replace(replace(replace(replace(regexp_replace(t, '&|/|:', '|', 'g'), 'originals', 'original'),
            'historical', 'history'), 'romantic comedy', 'romance|comedy'), 'sports', 'sport'), 'documentaries', 'documentary') as t from g)
    select p_partkey, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(t, '|'), lambda x: trim(x)), lambda x: length(x) > 0))), ';') as tags
    from c
    """,
)
def text_genres(spark, d):
    k = F.col("p_partkey")
    first = F.lower(F.concat("p_name", F.when(k % 3 == 0, " & sports/historical").otherwise(":originals")))
    second = F.when(k % 5 == 0, "romantic comedy").otherwise("documentaries")
    tags = t.genre_tokens(first, second, F.lower("p_type"))
    return s.table(spark, d, "part").select("p_partkey", F.array_join(tags, ";").alias("tags"))


@query(
    "text_licensors",
    r"""
    with l as (select s_suppkey, lower(s_name) || case s_suppkey % 6 when 0 then ' inc., lionsgate' when 1 then ' llc/tbs'
            when 2 then ', princess films inc' when 3 then ' ltd., ab' when 4 then ' lp, universal city studios productions'
            else ', cartoon network studios' end as t from supplier),
        c as (select s_suppkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(
            regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '\binc\.', '', 'g'), '\binc\b', '', 'g'), '\bllc\b', '', 'g'),
            '\bltd\.', '', 'g'), '/', ','), '\blp\b', '', 'g'), 'cartoon network productions|cartoon network studios', 'the cartoon network', 'g'),
            'turner entertainment networks|tbs|turner classic movies', 'turner system', 'g'),
            'universal city studios productions', 'universal studios', 'g'), 'lions gate films|lionsgate', 'lion gate', 'g') as t from l)
    select s_suppkey, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(t, ','), lambda x: trim(x)), lambda x: length(x) > 2))), ';') as licensors
    from c
    """,
)
def text_licensors(spark, d):
    suffix = [" inc., lionsgate", " llc/tbs", ", princess films inc", " ltd., ab", " lp, universal city studios productions", ", cartoon network studios"]
    picked = F.element_at(F.array(*[F.lit(x) for x in suffix]), (F.col("s_suppkey") % 6 + 1).cast("int"))
    names = F.concat(F.lower("s_name"), picked)
    return s.table(spark, d, "supplier").select(
        "s_suppkey", F.array_join(t.licensor_tokens(names), ";").alias("licensors")
    )


_FOLDED = ((r"supplier#0*1\d*", "first house"), (r"supplier#0*2\d*", "second house"))


@query(
    "text_licensors_folded",
    rf"""
    with c as (select s_suppkey, regexp_replace(regexp_replace(lower(s_name) || ', other studios / partners ltd.',
            '{_FOLDED[0][0]}', '{_FOLDED[0][1]}', 'g'), '{_FOLDED[1][0]}', '{_FOLDED[1][1]}', 'g') as t from supplier),
        d as (select s_suppkey, replace(regexp_replace(t, '\bltd\.', '', 'g'), '/', ',') as t from c)
    select s_suppkey, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(t, ','), lambda x: trim(x)), lambda x: length(x) > 2))), ';') as licensors
    from d
    """,
)
def text_licensors_folded(spark, d):
    """Brands folded into one name by rules that the caller gives."""
    names = F.concat(F.lower("s_name"), F.lit(", other studios / partners ltd."))
    return s.table(spark, d, "supplier").select(
        "s_suppkey", F.array_join(t.licensor_tokens(names, _FOLDED), ";").alias("licensors")
    )


# --- neighbours -----------------------------------------------------------------------------

_TREND_FLOOR = "2023-02-10 00:00:00"
_NEIGHBOURS = f"""
    with v as (select vec_id, embedding::double[] as e, timestamp '2023-01-01' + to_days((vec_id % 120)::integer) as ts,
            case when vec_id % 4 <> 0 then label end as target from embeddings),
        r as (select q.vec_id as id, b.vec_id as neighbour, b.target,
            row_number() over (partition by q.vec_id order by list_distance(q.e, b.e), b.vec_id::varchar) as rank
            from v q join v b on b.target is not null and b.ts + interval 28 day < q.ts and q.ts > timestamp '{_TREND_FLOOR}')
"""


def _curve_titles(spark, d):
    key = F.col("vec_id")
    return s.table(spark, d, "embeddings").select(
        key.cast("string").alias("id"),
        (s.ts("2023-01-01 00:00:00") + F.make_dt_interval(days=(key % 120).cast("int"))).alias("launched_at"),
        F.col("embedding").alias("curve"),
        F.when(key % 4 != 0, F.col("label")).alias("target"),
    )


def _neighbours(spark, d):
    titles = _curve_titles(spark, d)
    return titles, trend_neighbours(titles, 3, block_rows=256, after=_TREND_FLOOR)


@query(
    "trend_neighbours",
    _NEIGHBOURS + "select id::varchar as id, rank, neighbour::varchar as neighbour, target::double as neighbour_target from r where rank <= 3",
)
def trend_neighbours_query(spark, d):
    _, found = _neighbours(spark, d)
    return found.select("id", big("rank").alias("rank"), "neighbour", "neighbour_target")


@query(
    "trend_features",
    _NEIGHBOURS
    + "select v.vec_id::varchar as id, "
    + ", ".join(f"coalesce(max(r.target) filter (rank = {i}), -2)::double as growth_trend_{i}_order" for i in (1, 2, 3))
    + " from v left join r on r.id = v.vec_id and rank <= 3 group by 1",
)
def trend_features_query(spark, d):
    titles, found = _neighbours(spark, d)
    return trend_features(titles, found, 3)
