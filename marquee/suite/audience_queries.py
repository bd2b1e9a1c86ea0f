"""Active users, hours watched, page views and incremental runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.constants import HOURS_WINDOW_NAMES, HOURS_WINDOWS
from marquee.operators.joins import one_to_one
from marquee.operators.pivots import max_pivot
from marquee.plans import actives, hours, pageviews
from marquee.session import scratch_path, stored
from marquee.sources.files import replace_table
from marquee.sources.tables import calendar
from marquee.streaming import incremental
from marquee.suite import standins as s
from marquee.suite.registry import big, iso, query, rnd, us
from marquee.suite.standins import launch_sql, sql, ts

FIRST, LAST = "2024-01-01", "2024-01-28"

_ACTIVES = {
    "ud": "select distinct user_id as u, ts::date as d from events",
    "starts": f"select unnest(generate_series(date '{FIRST}', date '{LAST}', interval 1 day))::date as start_date",
    "firsts": """
        select start_date, u, min(d) as end_date from starts join ud on d between start_date and start_date + 28
        group by 1, 2""",
    "den": """
        select start_date, end_date, count(*) as daily, cast(sum(count(*)) over (partition by start_date
            order by end_date rows between unbounded preceding and current row) as bigint) as cumulative,
            date_diff('day', start_date, end_date) + 1 as days_after_launch
        from firsts group by 1, 2""",
}


def _denominators(spark, d):
    seen = s.table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"))
    return actives.cumulative_actives(seen, "user_id", "day", FIRST, LAST)


@query(
    "cumulative_actives",
    sql(
        "",
        "select strftime(start_date, '%Y-%m-%d') as start_date, strftime(end_date, '%Y-%m-%d') as end_date, "
        "daily as daily_viewing_subs_denom, cumulative as cumulative_viewing_subs_denom, "
        "days_after_launch from den",
        **_ACTIVES,
    ),
)
def cumulative_actives(spark, d):
    return _denominators(spark, d).select(
        iso("start_date").alias("start_date"), iso("end_date").alias("end_date"), "daily_viewing_subs_denom",
        big("cumulative_viewing_subs_denom").alias("cumulative_viewing_subs_denom"),
        big("days_after_launch").alias("days_after_launch"),
    )


# title days: viewers of title k up to each day since its launch
_TITLE_DAYS = f"""
    select k, {launch_sql('k')} as launch, date_diff('day', ({launch_sql('k')})::date, ts::date) + 1 as dn, count(*) as n
    from ev where event_type = 'view' and ts >= {launch_sql('k')} group by 1, 2, 3"""


def _title_days(spark, d):
    k = F.col("k")
    seen = s.events(spark, d, "view").withColumn("launch", s.launch_of(k)).where(F.col("ts") >= F.col("launch"))
    return seen.groupBy(
        "k", "launch", (F.datediff("ts", "launch") + 1).alias("days_on_platform")
    ).agg(F.count(F.lit(1)).alias("cumulative_viewing_subs"))


@query(
    "title_pct_actives",
    sql(
        "ev",
        """
        select 'M' || t.k as match_id, 'TITLE ' || t.k as title, dn as days_on_platform,
            round(n * 100.0 / cumulative, 6) as pct_actives
        from td t join part on p_partkey = t.k and p_type <> 'PROMO'
        join den on den.start_date = t.launch::date and den.days_after_launch = t.dn
        where dn between 1 and 28 and days_after_launch <= 28""",
        td=_TITLE_DAYS,
        **_ACTIVES,
    ),
    wide=("days_on_platform",),
)
def title_pct_actives(spark, d):
    number = F.col("k").cast("string")
    days = _title_days(spark, d)
    facts = days.select(
        F.concat(F.lit("TITLE "), number).alias("title"), "k", F.col("launch").alias("first_release_date"),
        "days_on_platform", "cumulative_viewing_subs",
    ).withColumnRenamed("k", "title_id")
    listed = s.table(spark, d, "part").where("p_type <> 'PROMO'").select(F.col("p_partkey").alias("k"))
    known = listed.select(
        F.concat(F.lit("Title "), number).alias("title"), F.col("k").alias("title_id"),
        F.concat(F.lit("M"), number).alias("match_id"),
    )
    rows = actives.title_pct_actives(facts, known, _denominators(spark, d))
    return rows.select("match_id", "title", "days_on_platform", rnd("pct_actives").alias("pct_actives"))


_OFFER = """
    select l_partkey as title_id, 'T' || l_partkey as title, 'M' || l_partkey as match_id,
        greatest(o_orderdate, timestamp '1998-06-01') as a, l_shipdate as b, o_orderdate as first_offered
    from orders join lineitem on o_orderkey = l_orderkey
    where l_shipdate >= timestamp '1998-06-01' and o_orderdate <= timestamp '1998-09-01'"""


def _offers(spark, d):
    orders = s.table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    number = F.col("l_partkey")
    text = number.cast("string")
    return s.table(spark, d, "lineitem").join(orders, "l_orderkey").select(
        number.alias("title_id"), F.concat(F.lit("T"), text).alias("title"), F.concat(F.lit("M"), text).alias("match_id"),
        F.col("o_orderdate").alias("offer_start"), F.col("l_shipdate").alias("offer_end"),
        F.col("o_orderdate").alias("first_offered"),
    )


@query(
    "title_offerings",
    sql(
        "",
        """
        select g.title_id, g.title, epoch_us(min(a)) as starts_us, epoch_us(max(b)) as ends_us,
            epoch_us(any_value(r.release)) as release_us
        from (select *, sum(case when reach is null or a > reach then 1 else 0 end) over (
                partition by title_id order by a, b rows unbounded preceding) as island
            from (select *, max(b) over (partition by title_id order by a, b rows between unbounded preceding and 1 preceding) as reach
                from (select distinct title_id, title, a, b from offer where b >= a))) g
        join (select title, min(first_offered) as release from offer group by 1) r on r.title = g.title
        group by g.title_id, g.title, island""",
        offer=_OFFER,
    ),
)
def title_offerings(spark, d):
    rows = actives.title_offerings(_offers(spark, d), ts("1998-09-01 00:00:00"), "1998-06-01 00:00:00")
    return rows.select(
        "title_id", "title", us("offer_start").alias("starts_us"), us("offer_end").alias("ends_us"),
        us("first_release_date").alias("release_us"),
    )


@query(
    "title_state",
    sql(
        "",
        "select title_id, epoch_us(max(b)) as end_us, case when max(b) >= timestamp '1998-09-01' then 0 else 1 end as inactive "
        "from offer where b >= a group by 1",
        offer=_OFFER,
    ),
)
def title_state(spark, d):
    run = ts("1998-09-01 00:00:00")
    spans = actives.title_offerings(_offers(spark, d), run, "1998-06-01 00:00:00")
    return actives.title_state(spans, run).select(
        "title_id", us("end_date").alias("end_us"), F.col("is_inactive").cast("int").alias("inactive")
    )


_CURVES = """
    select k % 4 as g, k, ts::date - date '2024-01-01' as day, count(*)::double as v from ev
    where event_type in ('view', 'click') group by 1, 2, 3"""
_MULTIPLIER = """
    select a.g, a.day as from_day, b.day as to_day, median(b.v / a.v) as multiplier
    from curves a join curves b on a.k = b.k and a.g = b.g group by 1, 2, 3"""


def _curves(spark, d):
    return s.events(spark, d, "view", "click").groupBy(
        (F.col("k") % 4).alias("g"), "k", F.datediff("ts", F.lit("2024-01-01").cast("date")).alias("day")
    ).agg(F.count(F.lit(1)).cast("double").alias("v"))


@query(
    "multiplier_model",
    sql(
        "ev",
        "select g, from_day, to_day, round(multiplier, 6) as multiplier from m",
        curves=_CURVES,
        m=_MULTIPLIER,
    ),
)
def multiplier_model(spark, d):
    m = actives.fit_multipliers(_curves(spark, d), ["g"], "k", "day", "v")
    return m.select("g", big("from_day").alias("from_day"), big("to_day").alias("to_day"), rnd("multiplier").alias("multiplier"))


@query(
    "multiplier_predict",
    sql(
        "ev",
        """
        select c.g, c.k, c.day, m.to_day as days_after_launch,
            round(case when c.day <= m.to_day then c.v * multiplier end, 6) as prediction
        from curves c left join m on m.g = c.g and m.from_day = c.day""",
        curves=_CURVES,
        m=_MULTIPLIER,
    ),
)
def multiplier_predict(spark, d):
    curves = _curves(spark, d)
    m = actives.fit_multipliers(curves, ["g"], "k", "day", "v")
    rows = actives.apply_multipliers(curves, m, ["g"], "day", "v")
    return rows.select(
        "g", "k", big("day").alias("day"), big("days_after_launch").alias("days_after_launch"),
        rnd("prediction").alias("prediction"),
    )


# --- hours -------------------------------------------------------------------

_FLOOR = "1995-06-01"
_RUN = "2001-06-30"
HOURS = {
    "streams": "select l_partkey as m, l_shipdate as seen_at, l_quantity as secs from lineitem "
    f"where l_quantity >= 5 and l_shipdate >= date '{_FLOOR}'",
    "offers": f"""
        select l_partkey as m, greatest(min(o_orderdate)::date, date '{_FLOOR}') as offer_date
        from lineitem join orders on o_orderkey = l_orderkey group by 1""",
    "wins": "select unnest([7, 14, 21, 28, 56, 91, 182, 364]) as w",
    "keys": "select distinct offer_date, w from offers, wins",
    "totals": """
        select offer_date, w, sum(secs) as total from keys
        join (select seen_at::date as d, sum(secs) as secs from streams group by 1) on d >= offer_date
            and d < offer_date + cast(w as integer) group by 1, 2""",
    "own": """
        select o.m, o.offer_date, w, sum(secs) as secs from offers o join wins on true join streams s on s.m = o.m
            and seen_at >= o.offer_date and seen_at < o.offer_date + cast(w as integer) group by 1, 2, 3""",
    "share": f"""
        select own.m as match_id, own.w as window_days, 100 * secs / total as score
        from own join totals t on t.offer_date = own.offer_date and t.w = own.w
        where own.offer_date + cast(own.w as integer) <= date '{_RUN}'""",
}


def _hours_inputs(spark, d):
    items = s.table(spark, d, "lineitem")
    streams = items.select(
        F.col("l_partkey").alias("match_id"), F.col("l_shipdate").alias("stream_at"),
        F.col("l_quantity").alias("stream_seconds"),
    )
    orders = s.table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    offers = items.select("l_orderkey", F.col("l_partkey").alias("match_id")).join(orders, "l_orderkey").groupBy(
        "match_id"
    ).agg(F.greatest(F.to_date(F.min("o_orderdate")), F.lit(_FLOOR).cast("date")).alias("offer_date"))
    return streams, offers


def _hours_share(spark, d, recorded=None):
    streams, offers = _hours_inputs(spark, d)
    return hours.hours_share(streams, offers, _RUN, recorded, floor=_FLOOR, min_seconds=5)


@query(
    "hours_share",
    sql("", "select match_id, window_days, round(score, 6) as score from share", **HOURS),
)
def hours_share(spark, d):
    return _hours_share(spark, d).select(
        "match_id", F.col("window").alias("window_days"), rnd("hourspct").alias("score")
    )


@query(
    "unscored_windows",
    sql(
        "",
        f"""
        select m as match_id, w as window_days, strftime(offer_date, '%Y-%m-%d') as offer_date
        from offers, wins where offer_date + cast(w as integer) <= date '{_RUN}'
            and not (m in (select p_partkey from part where p_type = 'PROMO') and w in (7, 28))""",
        offers=HOURS["offers"],
        wins=HOURS["wins"],
    ),
)
def unscored_windows(spark, d):
    _, offers = _hours_inputs(spark, d)
    recorded = s.table(spark, d, "part").where("p_type = 'PROMO'").select(
        F.col("p_partkey").alias("match_id"), F.explode(F.array(F.lit(7), F.lit(28))).alias("window")
    )
    rows = hours.unscored_windows(offers, recorded, _RUN, HOURS_WINDOWS)
    return rows.select("match_id", F.col("window").alias("window_days"), iso("offer_date").alias("offer_date"))


@query(
    "hours_title_offers",
    sql(
        "assets",
        """
        select match_id, strftime(greatest(min(offered)::date, date '2024-01-05'), '%Y-%m-%d') as offer_date,
            min(title) as match_title
        from (select case when content_category = 'series' then series_id || '-' || coalesce(season_number, 1)
                else viewable_id end as match_id, first_offered_date_current as offered,
                case when series_title_long is not null
                    then series_title_long || ' (Season ' || coalesce(season_number, 1) || ')' else asset_title_long end as title
            from assets where asset_type = 'FEATURE') group by 1""",
    ),
)
def hours_title_offers(spark, d):
    rows = hours.title_offers(
        s.assets(spark, d).withColumnRenamed("first_offered_date_current", "offered_at"), "2024-01-05"
    )
    return rows.select("match_id", iso("offer_date").alias("offer_date"), "match_title")


@query(
    "window_pivot",
    sql(
        "",
        "select match_id, "
        + ", ".join(f"round(max(score) filter (window_days = {w}), 6) as {n}" for w, n in HOURS_WINDOW_NAMES.items())
        + " from share group by 1",
        **HOURS,
    ),
)
def window_pivot(spark, d):
    wide = max_pivot(_hours_share(spark, d), "match_id", "window", "hourspct", HOURS_WINDOW_NAMES)
    return wide.select("match_id", *[rnd(n).alias(n) for n in HOURS_WINDOW_NAMES.values()])


# --- page views ------------------------------------------------------------------

# titles of the catalogue tracked under an outside id; every ninth id is shared
_TRACKED = {
    "catalog": """
        select viewable_id, case when k % 12 <> 5 then 'tt' || lpad((case when k % 9 = 0 then k - k % 18 else k end)::varchar, 8, '0') end as title_ref,
            'ts' || lpad((k // 6)::varchar, 7, '0') as series_ref from assets""",
    "ft": """
        select distinct coalesce(series_title_long || ' S' || coalesce(season_number, 1), asset_title_long) as title_name,
            coalesce(series_id || '-' || coalesce(season_number, 1), viewable_id) as match_id,
            case when k % 5 = 0 then 'legacy' else 'current' end as platform_name, first_offered_date_current as launch
        from assets""",
    "tracked": """
        select distinct title_name, flag || '-' || match_id as match_id_platform, title_ref as outside_id, launch,
            case when content_category = 'movies' then 'movie' else content_category end as category
        from (select *, case when platform_name = 'legacy' then '0' else '1' end as flag from ft)
        join assets on assets.viewable_id = match_id join catalog on catalog.viewable_id = match_id
        where content_category in ('movies', 'special') and length(title_ref) in (9, 10)
            and launch >= timestamp '2024-01-03'
        union
        select distinct title_name, flag || '-' || match_id, series_ref, launch, 'series'
        from (select *, case when platform_name = 'legacy' then '0' else '1' end as flag from ft)
        join assets on assets.series_id = split_part(match_id, '-', 1) join catalog on catalog.viewable_id = assets.viewable_id
        where content_category = 'series' and length(series_ref) in (9, 10) and launch >= timestamp '2024-01-03'""",
}


def _tracked(spark, d):
    assets = s.assets(spark, d)
    k = F.col("k")
    shared = F.when(k % 9 == 0, k - k % 18).otherwise(k).cast("string")
    catalog = assets.select(
        "viewable_id",
        F.when(k % 12 != 5, F.concat(F.lit("tt"), F.lpad(shared, 8, "0"))).alias("title_ref"),
        F.concat(F.lit("ts"), F.lpad(F.floor(k / 6).cast("string"), 7, "0")).alias("series_ref"),
    )
    season = F.coalesce("season_number", F.lit(1)).cast("string")
    titles = assets.select(
        F.coalesce(F.concat("series_title_long", F.lit(" S"), season), "asset_title_long").alias("title_name"),
        F.coalesce(F.concat("series_id", F.lit("-"), season), "viewable_id").alias("match_id"),
        F.when(k % 5 == 0, "legacy").otherwise("current").alias("platform_name"),
        F.col("first_offered_date_current").alias("launch"),
    ).distinct()
    # series keys of the test data differ in length; padding makes the prefix rule apply
    padded = titles.withColumn("match_id", _padded(F.col("match_id")))
    listed = assets.withColumn("series_id", F.rpad("series_id", 21, "_"))
    rows = pageviews.tracked_titles(listed, padded, catalog, "2024-01-03")
    return rows.withColumn("match_id_platform", F.replace("match_id_platform", F.lit("_"), F.lit("")))


def _padded(match):
    series, season = F.split_part(match, F.lit("-"), F.lit(1)), F.split_part(match, F.lit("-"), F.lit(2))
    return F.when(season != "", F.concat(F.rpad(series, 21, "_"), F.lit("-"), season)).otherwise(match)


@query(
    "tracked_titles",
    sql(
        "assets",
        "select title_name, match_id_platform, outside_id, epoch_us(launch) as launch_us, category from tracked",
        **_TRACKED,
    ),
)
def tracked_titles(spark, d):
    return _tracked(spark, d).select(
        "title_name", "match_id_platform", "outside_id", us("launch").alias("launch_us"), "category"
    )


@query(
    "social_title_list",
    sql(
        "assets",
        "select distinct outside_id as tracking_group_id, 'en' as language, category, title_name as query_term from tracked",
        **_TRACKED,
    ),
)
def social_title_list(spark, d):
    return pageviews.social_title_list(_tracked(spark, d))


PAGEVIEWS = {
    "titles0": f"""
        select 'Title ' || p as title_name, (case when p % 5 = 0 then '0-' else '1-' end) || 'V' || p as match_id_platform,
            'tt' || (case when p % 10 = 3 then p - 1 else p end) as outside_id, {launch_sql('p')} + interval 10 day as launch
        from (select p_partkey as p from part)""",
    "idmap": "select distinct 'tt' || k as outside_id, 'a' || k as article from ev",
    "linked": "select t.* from titles0 t where outside_id in (select outside_id from idmap)",
    "one": "select match_id_platform from linked group by 1 having count(distinct outside_id) < 2",
    "two": "select outside_id from linked group by 1 having count(distinct match_id_platform) < 2",
    "pv": """
        select title_name, match_id_platform, l.outside_id, launch, d, date_diff('day', launch::date, d) as n,
            cast(sum(pv) as bigint) as total_page_views
        from linked l join idmap using (outside_id)
        join (select 'a' || k as article, ts::date as d, count(*) as pv from ev where event_type = 'click' group by 1, 2) v
            using (article)
        where match_id_platform in (select * from one) and l.outside_id in (select * from two)
            and d::timestamp between launch - interval 64 day and launch + interval 28 day
        group by 1, 2, 3, 4, 5, 6""",
}


def page_titles(spark, d):
    p = F.col("p_partkey")
    return s.table(spark, d, "part").select(
        F.concat(F.lit("Title "), p.cast("string")).alias("title_name"),
        F.concat(F.when(p % 5 == 0, "0-V").otherwise("1-V"), p.cast("string")).alias("match_id_platform"),
        F.concat(F.lit("tt"), F.when(p % 10 == 3, p - 1).otherwise(p).cast("string")).alias("outside_id"),
        (s.launch_of(p) + F.make_dt_interval(days=F.lit(10))).alias("launch"),
    )


def page_view_rows(spark, d):
    k = F.col("k").cast("string")
    found = s.events(spark, d)
    id_map = stored(
        found.select(F.concat(F.lit("tt"), k).alias("outside_id"), F.concat(F.lit("a"), k).alias("article")).distinct()
    )
    views = (
        s.events(spark, d, "click")
        .groupBy(F.concat(F.lit("a"), k).alias("article"), iso("ts").alias("date"))
        .agg(F.count(F.lit(1)).alias("page_views"))
    )
    return pageviews.page_view_table(views, id_map, page_titles(spark, d))


@query(
    "pageview_table",
    sql(
        "ev",
        "select title_name, strftime(d, '%Y-%m-%d') as date, n as days_since_first_offered, match_id_platform, "
        "outside_id, epoch_us(launch) as launch_us, total_page_views from pv",
        **PAGEVIEWS,
    ),
)
def pageview_table(spark, d):
    return page_view_rows(spark, d).select(
        "title_name", iso("date").alias("date"), big("days_since_first_offered").alias("days_since_first_offered"),
        "match_id_platform", "outside_id", us("launch").alias("launch_us"), "total_page_views",
    )


@query(
    "pageviews_before",
    sql(
        "ev",
        "select t.match_id_platform, round(coalesce(sum(total_page_views) filter (n < -5), -1), 6)::double as wiki_befored28_total "
        "from (select distinct match_id_platform from titles0) t left join (select match_id_platform, n, "
        "total_page_views from pv where n < -5) p using (match_id_platform) group by 1",
        **PAGEVIEWS,
    ),
)
def pageviews_before(spark, d):
    """Shifted by 22 days: the month of events only reaches 29 days before a launch."""
    table = page_view_rows(spark, d).withColumn("days_since_first_offered", F.col("days_since_first_offered") - 22)
    return pageviews.views_before(table, page_titles(spark, d)).select(
        "match_id_platform", "wiki_befored28_total"
    )


def _cumulative_sql(first: int, last: int, days, suffix: str, sign: str) -> str:
    columns = ", ".join(
        f"coalesce(max(c) filter (n = {sign}{x}), -1)::double as day{x:03d}_{suffix}" for x in days
    )
    return sql(
        "ev",
        f"select t.match_id_platform, {columns} from (select distinct match_id_platform from titles0) t "
        "left join cum using (match_id_platform) group by 1",
        **PAGEVIEWS,
        cum=f"select match_id_platform, n, sum(sum(total_page_views)) over (partition by match_id_platform order by n) as c "
        f"from pv where n between {first} and {last} group by 1, 2",
    )


@query("pageviews_cumulative_before", _cumulative_sql(-27, 0, range(27, -1, -1), "wiki_d28", "-"))
def pageviews_cumulative_before(spark, d):
    return pageviews.cumulative_views_before(page_view_rows(spark, d), page_titles(spark, d))


@query("pageviews_cumulative_after", _cumulative_sql(1, 27, range(1, 28), "wiki_view", ""))
def pageviews_cumulative_after(spark, d):
    return pageviews.cumulative_views_after(page_view_rows(spark, d), page_titles(spark, d))


@query(
    "one_to_one_guard",
    """
    with pairs as (select distinct round(c_acctbal)::bigint as balance, c_custkey * 2 // 3 as household from customer)
    select balance, household from pairs
    where balance in (select balance from pairs group by 1 having count(*) < 2)
        and household in (select household from pairs group by 1 having count(*) < 2)
    """,
)
def one_to_one_guard(spark, d):
    pairs = s.table(spark, d, "customer").select(
        F.round("c_acctbal").cast("bigint").alias("balance"), F.floor(F.col("c_custkey") * 2 / 3).alias("household")
    ).distinct()
    return one_to_one(pairs, "balance", "household")


# --- incremental runs -----------------------------------------------------------------


@query(
    "missing_dates",
    f"""
    select strftime(d, '%Y-%m-%d') as missing_date
    from (select unnest(generate_series(date '{FIRST}', date '2024-02-10', interval 1 day))::date as d)
    where d not in (select ts::date from events where event_type = 'purchase' and value > 200)
    """,
)
def missing_dates(spark, d):
    recorded = s.table(spark, d, "events").where("event_type = 'purchase' and value > 200").select(
        F.to_date("ts").alias("day")
    )
    rows = incremental.missing_dates(recorded, "day", calendar(spark, FIRST, "2024-02-10"))
    return rows.select(iso("seq_date").alias("missing_date"))


@query(
    "high_water",
    sql(
        "ev",
        "select event_type as platform, k % 10 as nday, strftime(max(ts)::date, '%Y-%m-%d') as last_update_date "
        "from ev group by 1, 2",
    ),
)
def high_water(spark, d):
    rows = s.events(spark, d).select(F.col("event_type").alias("platform"), (F.col("k") % 10).alias("nday"), "ts")
    marks = incremental.high_water(rows, ["platform", "nday"], "ts")
    return marks.select("platform", "nday", iso("last_update_date").alias("last_update_date"))


@query(
    "due_runs",
    sql(
        "ev",
        """
        select p as platform, n as nday from (select unnest(['view', 'click', 'trailer']) as p),
            (select unnest(generate_series(0, 12)) as n)
        left join (select event_type, k % 10 as nday, max(ts)::date as m from ev where value > 150 group by 1, 2) e
            on event_type = p and nday = n
        where m is null or m < date '2024-01-28'""",
    ),
)
def due_runs(spark, d):
    rows = s.events(spark, d).where("value > 150").select(
        F.col("event_type").alias("platform"), (F.col("k") % 10).alias("nday"), "ts"
    )
    marks = incremental.high_water(rows, ["platform", "nday"], "ts")
    planned = spark.range(0, 13).withColumnRenamed("id", "nday").withColumn(
        "platform", F.explode(F.array(F.lit("view"), F.lit("click"), F.lit("trailer")))
    )
    return incremental.due(planned, marks, ["platform", "nday"], "2024-01-28").select("platform", "nday")


@query(
    "empty_runs",
    sql(
        "ev",
        """
        select p as platform, n as nday from (select unnest(['view', 'click', 'trailer']) as p),
            (select unnest(generate_series(0, 12)) as n)
        left join (select event_type, k % 10 as nday, max(ts)::date as m from ev where value > 150 group by 1, 2) e
            on event_type = p and nday = n
        where (m is null or m < date '2024-01-28') and not (p = 'trailer' and n >= 10)""",
    ),
)
def empty_runs(spark, d):
    """Runs that found nothing record their state, so they are not due again."""
    rows = s.events(spark, d).where("value > 150").select(
        F.col("event_type").alias("platform"), (F.col("k") % 10).alias("nday"), "ts"
    )
    path = scratch_path(spark)
    for nday in (10, 11, 12):
        incremental.record_empty_run(spark, path, "trailers", "trailer", nday, "2024-01-28")
    state = spark.read.parquet(path).select("platform", F.col("nday").cast("bigint").alias("nday"), "last_update_date")
    marks = incremental.high_water(rows, ["platform", "nday"], "ts").unionByName(state)
    planned = spark.range(0, 13).withColumnRenamed("id", "nday").withColumn(
        "platform", F.explode(F.array(F.lit("view"), F.lit("click"), F.lit("trailer")))
    )
    latest = incremental.high_water(marks, ["platform", "nday"], "last_update_date")
    return incremental.due(planned, latest, ["platform", "nday"], "2024-01-28").select("platform", "nday")


@query(
    "rolling_rebuild",
    """
    select strftime(ts::date, '%Y-%m-%d') as day, count(*) as n_events,
        case when ts::date >= date '2024-01-20' - 7 then 'rebuilt' else 'kept' end as origin
    from events where ts::date <= date '2024-01-25' group by ts::date
    """,
)
def rolling_rebuild(spark, d):
    """Daily counts recorded until the 20th; the last week and the days up to the 25th are rebuilt."""
    daily = s.table(spark, d, "events").groupBy(iso("ts").alias("day")).agg(F.count(F.lit(1)).alias("n_events"))
    path = scratch_path(spark) + "/daily"
    replace_table(daily.where("day <= '2024-01-20'").withColumn("origin", F.lit("kept")), path, ["day"])

    def build(first, last):
        return daily.where(F.col("day").between(first, last)).withColumn("origin", F.lit("rebuilt"))

    rows = incremental.rebuild_tail(spark, path, "day", build, "2024-01-25", 7)
    return rows.select(iso("day").alias("day"), "n_events", "origin")
