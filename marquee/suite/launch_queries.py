"""Subscriptions, launch funnel and trailers."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.constants import FUNNEL_DAYS
from marquee.operators.audience import audience_counts
from marquee.operators.intervals import merge_intervals
from marquee.operators.segments import DEFAULT_LIMIT, SkewLimit
from marquee.operators.quality import check_rules, duplicate_keys
from marquee.plans import funnel, trailers
from marquee.plans.subscriptions import SESSION_KEYS, active_islands
from marquee.session import stored
from marquee.suite import standins as s
from marquee.suite.registry import big, query, rnd, us
from marquee.suite.standins import END_TS, sql, ts


@query(
    "sub_periods",
    sql(
        "periods",
        "select user_id, provider, is_trial, platform_name, epoch_us(starts_at) as starts_us, "
        "epoch_us(ends_at) as ends_us from periods",
    ),
)
def sub_periods(spark, d):
    return s.periods(spark, d).select(
        "user_id", "provider", "is_trial", "platform_name", us("starts_at").alias("starts_us"), us("ends_at").alias("ends_us")
    )


@query(
    "sub_sessions",
    sql(
        "sessions",
        "select user_id, provider, platform_name, is_trial, session_id, epoch_us(starts_at) as starts_us, "
        "epoch_us(ends_at) as ends_us from sessions",
    ),
)
def sub_sessions(spark, d):
    return s.sessions(spark, d).select(
        *SESSION_KEYS, big("session_id").alias("session_id"), us("starts_at").alias("starts_us"), us("ends_at").alias("ends_us")
    )


@query(
    "sub_sessions_one_day_gap",
    sql(
        "ev",
        """
        select user_id, cast(session_id as bigint) as session_id, epoch_us(min(a)) as starts_us, epoch_us(max(b)) as ends_us
        from (select *, sum(case when a >= prev and a <= prev + interval 1 day then 0 else 1 end)
                over (partition by user_id order by a) as session_id
            from (select *, lag(b) over (partition by user_id order by a, b) as prev
                from (select user_id, ts as a, ts + interval 3 day as b from ev where event_type = 'signup')))
        group by 1, 2""",
    ),
)
def sub_sessions_one_day_gap(spark, d):
    from marquee.operators.intervals import chain_periods

    raw = s.events(spark, d, "signup").select(
        "user_id", F.col("ts").alias("a"), (F.col("ts") + F.make_dt_interval(days=F.lit(3))).alias("b")
    )
    return chain_periods(raw, ["user_id"], "a", "b", max_gap_seconds=86_400).select(
        "user_id", big("session_id").alias("session_id"), us("a").alias("starts_us"), us("b").alias("ends_us")
    )


_MERGED = """
    with v as (select distinct {key} as part, o_orderdate as s, l_shipdate as e
            from orders join lineitem on o_orderkey = l_orderkey where l_shipdate >= o_orderdate),
        f as (select *, max(e) over (partition by part order by s, e rows between unbounded preceding and 1 preceding) as reach from v),
        g as (select *, sum(case when reach is null or s > reach then 1 else 0 end)
            over (partition by part order by s, e rows unbounded preceding) as island from f)
    select part, epoch_us(min(s)) as starts_us, epoch_us(max(e)) as ends_us from g group by part, island
"""


def _merged(spark, d, part, limit=DEFAULT_LIMIT):
    orders = s.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("s"))
    spans = s.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), part.alias("part"), F.col("l_shipdate").alias("e")
    ).join(orders, "o_orderkey")
    merged = merge_intervals(spans, ["part"], "s", "e", limit)
    return merged.select("part", us("s").alias("starts_us"), us("e").alias("ends_us"))


@query("interval_merge", _MERGED.format(key="l_partkey"))
def interval_merge(spark, d):
    return _merged(spark, d, F.col("l_partkey"))


@query(
    "interval_merge_split",
    _MERGED.format(key="case when l_partkey % 3 = 0 then null when l_partkey % 3 = 1 then 1 else l_partkey end"),
)
def interval_merge_split(spark, d):
    """A third of the rows on one key and a third on the null key: both are cut into segments."""
    part = F.when(F.col("l_partkey") % 3 == 1, 1).when(F.col("l_partkey") % 3 == 2, F.col("l_partkey"))
    return _merged(spark, d, part, SkewLimit(rows=500))


def _streams(spark, d):
    titles = funnel.asset_titles(s.assets(spark, d), "first_offered_date_current")
    launches = stored(funnel.title_launches(titles))
    streams = funnel.title_views(s.views(spark, d), titles, launches, s.edits(spark, d))
    return titles, launches, streams


@query(
    "title_launches",
    sql(
        "launches",
        "select title_name, match_id, epoch_us(launch) as launch_us, epoch_us(last_offered) as last_us, "
        "epoch_us(earliest_public) as public_us, season_number_adj, content_category, single_episode_ind, "
        "viewable_id_count from launches",
    ),
)
def title_launches(spark, d):
    titles = funnel.asset_titles(s.assets(spark, d), "first_offered_date_current")
    return funnel.title_launches(titles).select(
        "title_name", "match_id", us("launch").alias("launch_us"), us("last_offered").alias("last_us"),
        us("earliest_public").alias("public_us"), big("season_number_adj").alias("season_number_adj"),
        "content_category", "single_episode_ind", "viewable_id_count",
    )


@query(
    "viewership_base",
    sql(
        "base",
        "select title_name, match_id, user_id, viewable_id, epoch_us(stream_at) as stream_us, "
        "epoch_us(launch) as launch_us, round(stream_hours, 6) as stream_hours, "
        "round(runtime_hours, 6) as runtime_hours, viewable_id_count from base",
    ),
)
def viewership_base(spark, d):
    _, _, streams = _streams(spark, d)
    base = funnel.viewership_base(streams, active_islands(s.sessions(spark, d)))
    return base.select(
        "title_name", "match_id", "user_id", "viewable_id", us("stream_at").alias("stream_us"),
        us("launch").alias("launch_us"), rnd("stream_hours").alias("stream_hours"),
        rnd("runtime_hours").alias("runtime_hours"), "viewable_id_count",
    )


_FUNNEL = f"""
    select u.title_name, u.match_id, cast(u.season_number_adj as bigint) as season_number_adj, u.content_category,
        epoch_us(u.launch) as launch_us, u.n as days_since_first_offered,
        cast(any_value(subs) as bigint) as total_retail_sub_count,
        count(*) as retail_played_count,
        cast(sum(case when (u.single_episode_ind = 1 and hours > least(2.0 / 60, run_time))
            or (u.single_episode_ind = 0 and done > 0) then 1 else 0 end) as bigint) as retail_viewed_count,
        cast(sum(case when done = u.viewable_id_count then 1 else 0 end) as bigint) as retail_completion_count,
        round(count(*) / nullif(any_value(subs), 0), 6) as retail_played_count_percent,
        round(sum(case when (u.single_episode_ind = 1 and hours > least(2.0 / 60, run_time))
            or (u.single_episode_ind = 0 and done > 0) then 1 else 0 end) / nullif(any_value(subs), 0), 6)
            as retail_viewed_count_percent
    from per_user u left join subs using (launch, n)
    where u.launch + to_days(u.n) <= timestamp '{END_TS}'
    group by 1, 2, 3, 4, 5, 6"""

_FUNNEL_PARTS = {
    "per_episode": """
        select l.title_name, l.match_id, l.season_number_adj, l.content_category, l.single_episode_ind, l.launch,
            l.viewable_id_count, b.user_id, b.viewable_id, n, max(runtime_hours) as run_time,
            case when max(runtime_hours) is not null then least(sum(stream_hours), max(runtime_hours)) end as hours,
            case when sum(stream_hours) > 0.9 * max(runtime_hours) then 1 else 0 end as done
        from base b join launches l using (title_name, match_id) join days28 on true
        where b.stream_at between l.launch and l.launch + to_days(n)
            and exists (select 1 from sessions p where p.user_id = b.user_id and p.ends_at >= l.launch
                and p.starts_at <= l.launch + to_days(n))
        group by all""",
    "per_user": """
        select title_name, match_id, season_number_adj, content_category, single_episode_ind, launch,
            viewable_id_count, user_id, n, max(run_time) as run_time, sum(hours) as hours, sum(done) as done
        from per_episode group by all having sum(hours) > 0""",
    "subs": """
        select launch, n, count(distinct user_id) as subs
        from (select distinct launch from launches) join days28 on true
        join sessions on ends_at >= launch and starts_at <= launch + to_days(n)
        where platform_name = 'current' group by 1, 2""",
}


@query("launch_funnel", sql("base launches days28", _FUNNEL, **_FUNNEL_PARTS))
def launch_funnel(spark, d):
    _, launches, streams = _streams(spark, d)
    sessions = s.stored_sessions(spark, d)
    rows = funnel.launch_funnel(
        streams, launches, active_islands(sessions), s.islands(sessions, "current"), ts(END_TS), "current", FUNNEL_DAYS
    )
    return rows.select(
        "title_name", "match_id", big("season_number_adj").alias("season_number_adj"), "content_category",
        us("earliest_offered_timestamp").alias("launch_us"), "days_since_first_offered", "total_retail_sub_count",
        "retail_played_count", "retail_viewed_count", "retail_completion_count",
        rnd("retail_played_count_percent").alias("retail_played_count_percent"),
        rnd("retail_viewed_count_percent").alias("retail_viewed_count_percent"),
    )


@query(
    "launch_audience",
    sql(
        "launches days28 sessions",
        "select epoch_us(launch) as launch_us, n, cast(coalesce(subs, 0) as bigint) as users "
        "from (select distinct launch from launches) join days28 on true left join subs using (launch, n)",
        subs=_FUNNEL_PARTS["subs"],
    ),
)
def launch_audience(spark, d):
    titles = funnel.asset_titles(s.assets(spark, d), "first_offered_date_current")
    anchors = stored(funnel.title_launches(titles).select(F.col("launch").alias("opens"), "launch").distinct())
    users = audience_counts(s.islands(s.sessions(spark, d), "current"), anchors, FUNNEL_DAYS, "starts_at", "ends_at")
    return users.select(us("launch").alias("launch_us"), "n", big("users").alias("users"))


_PRE_TS = "2024-01-08 00:00:00"


@query(
    "prelaunch_titles",
    sql(
        "titles",
        f"""
        select title_name, match_id, cast(season_number_adj as bigint) as season_number_adj, content_category,
            single_episode_ind, epoch_us(min(offered_at)) as first_us, epoch_us(max(offered_at)) as last_us,
            epoch_us(min(public_at)) as public_us, 0 as days_since_first_offered,
            cast(null as bigint) as retail_played_count
        from titles where match_id not in (select 'V' || k from ev0 where k is not null)
        group by 1, 2, 3, 4, 5
        having min(offered_at) between timestamp '{_PRE_TS}' and timestamp '{_PRE_TS}' + interval 90 day""",
        ev0="select distinct cast(json_extract_string(props, '$.k') as bigint) as k from events where event_type = 'error'",
    ),
)
def prelaunch_titles(spark, d):
    titles = funnel.asset_titles(s.assets(spark, d), "first_offered_date_current")
    recorded = s.events(spark, d, "error").select(
        F.concat(F.lit("V"), F.col("k").cast("string")).alias("match_id"),
        F.lit("current").alias("platform_name"),
        F.lit(0).alias("days_since_first_offered"),
    )
    rows = funnel.prelaunch_titles(titles, ts(_PRE_TS), "current", recorded)
    return rows.select(
        "title_name", "match_id", big("season_number_adj").alias("season_number_adj"), "content_category",
        "single_episode_ind", us("earliest_offered_timestamp").alias("first_us"),
        us("last_offered_timestamp").alias("last_us"), us("earliest_public_timestamp").alias("public_us"),
        "days_since_first_offered", "retail_played_count",
    )


# --- trailers: every part is also advertised by a trailer asset T<k> ---------------

_TITLES_T = f"""
    select 'Show ' || k || ' S1' as title_name, 'M' || k as match_id, 'current' as platform_name,
        {s.launch_sql('k')} + interval 8 day as launch from (select p_partkey as k from part)"""
_LINKS = f"""
    select title_name, match_id, 'T' || k as viewable_id, {s.launch_sql('k')} - to_days(cast(k % 30 as integer)) as trailer_at,
        launch from (select p_partkey as k from part) join titles_t on title_name = 'Show ' || k || ' S1'"""
_TRAILER_CORE = """
    select w.title_name, w.match_id, w.n, date_diff('day', w.opens::date, (w.launch + to_days(w.n))::date) as cumulative_day_num,
        count(distinct v.viewable_id) as total_trailer_num, count(distinct v.user_id) as view_count,
        any_value(u.users) as users
    from w join (select 'T' || k as viewable_id, user_id, ts as at, value * 20 as secs from ev where event_type = 'click') v
        on v.viewable_id = w.viewable_id
    left join subs u on u.opens = w.opens and u.launch = w.launch and u.n = w.n
    where secs > 10 and v.at between w.opens and w.launch + to_days(w.n) and v.at <= {end}
        and w.launch + to_days(w.n) < {end} and w.trailer_at < w.launch
        and date_diff('day', w.opens::date, (w.launch + to_days(w.n))::date) > 0
    group by 1, 2, 3, 4"""
_TRAILER_SUBS = """
    select a.opens, a.launch, a.n, count(distinct p.user_id) as users
    from (select distinct opens, launch, n from w) a
    join sessions p on p.ends_at >= a.opens and p.starts_at <= a.launch + to_days(a.n)
    where p.platform_name = 'current' group by 1, 2, 3"""
_TRAILER_OUT = (
    "select title_name, match_id, n as nday_before, cast(cumulative_day_num as bigint) as cumulative_day_num, "
    "total_trailer_num, view_count, cast(users as bigint) as total_retail_sub_count, "
    "round(view_count / nullif(users, 0), 6) as retail_trailer_view_metric from core"
)


def _trailer_sql(days: str, opens: str, launch: str = "launch") -> str:
    end = f"timestamp '{END_TS}'"
    return sql(
        "ev sessions",
        _TRAILER_OUT,
        titles_t=_TITLES_T,
        links=_LINKS,
        w=f"select * replace ({launch} as launch), {opens} as opens, n from links, (select unnest(generate_series({days}))::integer as n)",
        subs=_TRAILER_SUBS,
        core=_TRAILER_CORE.format(end=end),
    )


def _trailer_inputs(spark, d):
    k = F.col("p_partkey")
    part = s.table(spark, d, "part").select("p_partkey")
    launch = s.launch_of(k)
    name = F.concat(F.lit("Show "), k.cast("string"))
    listed = part.select(
        F.concat(F.lit("T"), k.cast("string")).alias("viewable_id"),
        F.concat(name, F.lit(": Season 1 Trailer")).alias("asset_title_long"),
        F.lit("Season 1").alias("asset_title_short"),
        (launch - F.make_dt_interval(days=(k % 30).cast("int"))).alias("offered"),
    )
    titles = part.select(
        F.concat(name, F.lit(" S1")).alias("title_name"),
        F.concat(F.lit("M"), k.cast("string")).alias("match_id"),
        F.lit("current").alias("platform_name"),
        (launch + F.make_dt_interval(days=F.lit(8))).alias("launch"),
    )
    found = trailers.trailer_assets(listed, listed, "offered", "current")
    links = trailers.trailer_links(found, titles, ts(END_TS))
    clicks = s.events(spark, d, "click").select(
        F.concat(F.lit("T"), F.col("k").cast("string")).alias("viewable_id"),
        "user_id",
        F.col("ts").alias("stream_at"),
        (F.col("value") * 20).alias("stream_seconds"),
    )
    return clicks, links


def _trailer_out(rows):
    return rows.select(
        "title_name", "match_id", "nday_before", big("cumulative_day_num").alias("cumulative_day_num"),
        "total_trailer_num", "view_count", big("total_retail_sub_count").alias("total_retail_sub_count"),
        rnd("retail_trailer_view_metric").alias("retail_trailer_view_metric"),
    )


@query(
    "trailer_links",
    sql(
        "ev",
        "select title_name, match_id, viewable_id, epoch_us(trailer_at) as trailer_us, epoch_us(launch) as launch_us from links",
        titles_t=_TITLES_T,
        links=_LINKS,
    ),
)
def trailer_links(spark, d):
    _, links = _trailer_inputs(spark, d)
    return links.select(
        "title_name", "match_id", "viewable_id", us("trailer_at").alias("trailer_us"), us("launch").alias("launch_us")
    )


@query("trailer_reach", _trailer_sql("-27, 0", "greatest(trailer_at, launch - interval 28 day)"))
def trailer_reach(spark, d):
    clicks, links = _trailer_inputs(spark, d)
    return _trailer_out(trailers.trailer_reach(clicks, links, s.islands(s.sessions(spark, d), "current"), ts(END_TS)))


@query("trailer_reach_until", _trailer_sql("-28, -28", "trailer_at", "launch + interval 30 day"))
def trailer_reach_until(spark, d):
    """Reach until 28 days before launches that follow 30 days later than those of the events."""
    clicks, links = _trailer_inputs(spark, d)
    links = links.withColumn("launch", F.col("launch") + F.make_dt_interval(days=F.lit(30)))
    rows = trailers.early_trailer_reach(clicks, links, s.islands(s.sessions(spark, d), "current"), ts(END_TS))
    return _trailer_out(rows)


@query(
    "session_key_check",
    sql(
        "sessions",
        """
        select 'ends_before_start' as rule, count(*) filter (ends_at < starts_at) as violations from sessions
        union all select 'missing_platform', count(*) filter (platform_name is null) from sessions
        union all select 'missing_user', count(*) filter (user_id is null) from sessions
        union all select 'unique_key', count(*) - (select count(*) from (select distinct user_id, provider,
            platform_name, is_trial, session_id from sessions)) from sessions""",
    ),
)
def session_key_check(spark, d):
    rules = {
        "ends_before_start": F.col("ends_at") < F.col("starts_at"),
        "missing_platform": F.col("platform_name").isNull(),
        "missing_user": F.col("user_id").isNull(),
    }
    return check_rules(s.sessions(spark, d), rules, [*SESSION_KEYS, "session_id"])


@query(
    "duplicate_keys",
    "select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1",
)
def duplicated(spark, d):
    return duplicate_keys(s.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])
