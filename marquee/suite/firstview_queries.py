"""First views: grid, reference graph, decay and its application."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions.metrics import log_zero_is_zero
from marquee.plans import firstviews
from marquee.session import stored
from marquee.suite import standins as s
from marquee.suite.registry import big, iso, query, rnd
from marquee.suite.standins import launch_sql, sql

RUN = "2024-01-28"
LAST_DAY = "2024-12-31"

_CATEGORY = "['Popcorn', 'Pay1', 'Specials', 'Library', 'Kids']"
_ASSETS = {
    "past": f"""
        select a.k as viewable, a.k // 4 as title_id, 'Name ' || (a.k // 4) as title_name, coalesce(a.season_number, 0) as season_number,
            a.content_category, {_CATEGORY}[a.k // 4 % 5 + 1] as category, a.k // 4 % 4 as tier,
            ({launch_sql('a.k')})::date as asset_premiere, ({launch_sql('a.k')} + to_days(cast(20 + a.k % 5 as integer)))::date as asset_end,
            coalesce(case when a.k % 2 = 0 then ({launch_sql('a.k')})::date end, ({launch_sql('a.k')} - interval 1 day)::date) as season_premiere,
            a.p_retailprice as run_time, date '2024-01-02' + cast(a.k // 4 % 6 as integer) as eff_start,
            date '2024-01-20' + cast(a.k // 4 % 9 as integer) as eff_end
        from assets a where a.asset_type in ('FEATURE', 'ELEMENT')
            and coalesce(case when a.k % 2 = 0 then {launch_sql('a.k')} end, {launch_sql('a.k')} - interval 1 day) >= timestamp '2024-01-02 01:00:00'""",
    "fv": f"""
        select title_id, title_name, season_number, content_category, category, tier, ts::date as day,
            count(distinct (user_id, sub)) as first_views
        from (select *, user_id % 3 as sub, ['US', 'PR', 'GU', 'MX'][event_id % 4 + 1] as country from ev where event_type = 'view')
        join past on viewable = k
        where country in ('US', 'PR', 'GU') and ts::date between asset_premiere and asset_end
            and ts::date between eff_start and eff_end and ts::date < date '{RUN}' - 1
        group by 1, 2, 3, 4, 5, 6, 7""",
    "hv": f"""
        select title_id, title_name, season_number, content_category, category, tier, ts::date as day,
            round(cast(sum(value * 20) / 3600 as decimal(18, 9)), 3) as hours_viewed
        from ev join past on viewable = k
        where event_type = 'view' and value * 20 >= 120 and ts::date between asset_premiere and asset_end
            and ts::date between eff_start and eff_end and ts::date < date '{RUN}' - 1
        group by 1, 2, 3, 4, 5, 6, 7""",
    "dates": f"""
        select title_id, title_name, season_number, content_category, category, tier, eff_start, d as day,
            case when d = eff_start then 1 else 0 end as premiere_ind,
            count(distinct case when d = asset_premiere then viewable end) as asset_premiere_count,
            round(cast(sum(distinct case when d = asset_premiere then run_time else 0 end) / 3600 as decimal(18, 9)), 3) as premiering
        from past, (select unnest(generate_series(date '2024-01-01', date '{LAST_DAY}' - 1, interval 1 day))::date as d)
        where d between coalesce(eff_start, season_premiere, asset_premiere)
            and coalesce(eff_start, season_premiere, asset_premiere) + 90 and d between eff_start and eff_end
        group by 1, 2, 3, 4, 5, 6, 7, 8""",
    "grid": f"""
        select dates.*, coalesce(first_views, 0) as first_views, coalesce(hours_viewed, 0) as hours_viewed,
            dates.day - eff_start as days_since_premiere, date '{RUN}' - eff_start - 1 as days_on_platform,
            case when date '{RUN}' - eff_start - 1 >= (case when category = 'Popcorn' and year(eff_start) < 2022 then 31 else 90 end)
                then 1 else 0 end as finished
        from dates left join hv using (title_id, season_number, day, content_category, category, tier)
        left join fv using (title_id, season_number, day, content_category, category, tier)""",
}


def _base(spark, d):
    listed = s.assets(spark, d)
    k = F.col("k")
    title = F.floor(k / 4)
    launch = F.col("first_offered_date_current")
    day = F.make_dt_interval
    categories = F.array(*[F.lit(c) for c in ("Popcorn", "Pay1", "Specials", "Library", "Kids")])
    assets = listed.select(
        title.alias("title_id"), "viewable_id", F.concat(F.lit("Name "), title.cast("string")).alias("title_name"),
        "season_number", "content_category", "asset_type", F.col("p_retailprice").alias("run_time"),
        launch.alias("starts_at"), (launch + day(days=(k % 5 + 20).cast("int"))).alias("ends_at"),
    )
    offers = listed.select(
        "viewable_id", launch.alias("first_offered"),
        F.when(k % 2 == 0, launch).alias("season_first_offered"),
        (launch - day(days=F.lit(1))).alias("title_first_offered"),
    )
    metadata = listed.select(
        title.alias("title_id"), "season_number",
        F.element_at(categories, (title % 5 + 1).cast("int")).alias("category"), (title % 4).cast("int").alias("tier"),
        F.date_add(F.lit("2024-01-02").cast("date"), (title % 6).cast("int")).alias("effective_start_date"),
        F.date_add(F.lit("2024-01-20").cast("date"), (title % 9).cast("int")).alias("effective_end_date"),
    ).distinct()
    return firstviews.base_assets(assets, offers, metadata, "2024-01-02 01:00:00")


def _first_views(spark, d, assets):
    watched = s.events(spark, d, "view").select(
        F.concat(F.lit("V"), F.col("k").cast("string")).alias("viewable_id"), "user_id",
        (F.col("user_id") % 3).alias("subscription_id"), F.col("ts").alias("request_at"),
        F.element_at(
            F.array(F.lit("US"), F.lit("PR"), F.lit("GU"), F.lit("MX")), (F.col("event_id") % 4 + 1).cast("int")
        ).alias("country"),
    )
    return firstviews.daily_first_views(watched, assets, RUN)


def _hours(spark, d, assets):
    streams = s.events(spark, d, "view").select(
        F.concat(F.lit("V"), F.col("k").cast("string")).alias("viewable_id"), F.col("ts").alias("request_at"),
        (F.col("value") * 20).alias("stream_seconds"),
    )
    return firstviews.daily_hours(streams, assets, RUN)


def grid_of(spark, d):
    assets = stored(_base(spark, d))
    return firstviews.daily_grid(assets, _first_views(spark, d, assets), _hours(spark, d, assets), RUN, LAST_DAY)


_TITLE = "title_id, season_number, content_category, category, cast(tier as integer) as tier"


@query(
    "base_assets",
    sql(
        "assets",
        "select 'V' || viewable as viewable_id, title_name, " + _TITLE + ", strftime(asset_premiere, '%Y-%m-%d') as asset_premiere, "
        "strftime(asset_end, '%Y-%m-%d') as asset_end, strftime(season_premiere, '%Y-%m-%d') as season_premiere, "
        "run_time, strftime(eff_start, '%Y-%m-%d') as effective_start, strftime(eff_end, '%Y-%m-%d') as effective_end from past",
        past=_ASSETS["past"],
    ),
    wide=("season_number",),
)
def base_assets(spark, d):
    return _base(spark, d).select(
        "viewable_id", "title_name", "title_id", "season_number", "content_category", "category", "tier",
        iso("asset_premiere").alias("asset_premiere"), iso("asset_end").alias("asset_end"),
        iso("season_premiere").alias("season_premiere"), "run_time",
        iso("effective_start_date").alias("effective_start"), iso("effective_end_date").alias("effective_end"),
    )


@query(
    "calendar_grid",
    sql(
        "ev assets",
        "select title_name, " + _TITLE + ", strftime(day, '%Y-%m-%d') as request_date, premiere_ind, asset_premiere_count, "
        "premiering::double as premiering_hours_runtime, first_views, hours_viewed::double as hours_viewed, "
        "days_since_premiere::bigint as days_since_premiere, days_on_platform::bigint as days_on_platform, "
        "finished as finished_window_flag from grid",
        **_ASSETS,
    ),
    wide=("season_number",),
)
def calendar_grid(spark, d):
    return grid_of(spark, d).select(
        "title_name", "title_id", "season_number", "content_category", "category", "tier",
        iso("request_date").alias("request_date"), "premiere_ind", "asset_premiere_count", "premiering_hours_runtime",
        "first_views", "hours_viewed", big("days_since_premiere").alias("days_since_premiere"),
        big("days_on_platform").alias("days_on_platform"), "finished_window_flag",
    )


# --- reference graph: parts refer to suppliers' other parts -----------------------------

_TYPES = "['follows', 'spin_off_from', 'remake_of', 'version_of', 'featured_in', 'edited_into']"
_GRAPH = {
    "links": f"select distinct l_partkey as title_ref, {_TYPES}[l_linenumber % 6 + 1] as reference_type, l_suppkey as reference_ref from lineitem",
    "names": "select p_partkey as title_ref, p_name as original_title from part",
    "titles": """
        select distinct k as title_ref, 'N' || (k // 2) as title_name, coalesce(season_number, 1) as season_number,
            content_category from assets""",
    "graph": """
        select distinct t.title_ref, title_name, season_number, content_category, a.reference_type,
            n1.title_ref as reference_title_id, n1.original_title as reference_title,
            case when n1.title_ref is not null then b.reference_type end as reference_reference_type,
            n2.title_ref as reference_reference_title_id
        from titles t join names n0 on n0.title_ref = t.title_ref
        join links a on a.title_ref = t.title_ref and a.reference_type in ('follows', 'spin_off_from', 'remake_of', 'version_of', 'featured_in')
        left join names n1 on n1.title_ref = a.reference_ref
        left join links b on b.title_ref = n1.title_ref and b.reference_type = 'featured_in'
        left join names n2 on n2.title_ref = b.reference_ref""",
    "keyed": "select * from graph",
}
_KEYS = ["title_name", "season_number", "content_category"]


def _graph(spark, d):
    types = F.array(*[F.lit(t) for t in ("follows", "spin_off_from", "remake_of", "version_of", "featured_in", "edited_into")])
    links = s.table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("title_ref"),
        F.element_at(types, (F.col("l_linenumber") % 6 + 1).cast("int")).alias("reference_type"),
        F.col("l_suppkey").alias("reference_ref"),
    )
    names = s.table(spark, d, "part").select(F.col("p_partkey").alias("title_ref"), F.col("p_name").alias("original_title"))
    titles = s.assets(spark, d).select(
        F.col("k").alias("title_ref"), F.concat(F.lit("N"), F.floor(F.col("k") / 2).cast("string")).alias("title_name"),
        F.coalesce("season_number", F.lit(1)).alias("season_number"), "content_category",
    )
    return stored(firstviews.reference_graph(titles, names, links))


@query(
    "reference_graph",
    sql(
        "assets",
        "select title_ref, title_name, season_number, content_category, reference_type, reference_title_id, "
        "reference_title, reference_reference_type, reference_reference_title_id from graph",
        **_GRAPH,
    ),
    wide=("season_number",),
)
def reference_graph(spark, d):
    return _graph(spark, d).select(
        "title_ref", "title_name", "season_number", "content_category", "reference_type", "reference_title_id",
        "reference_title", "reference_reference_type", "reference_reference_title_id",
    )


_FEATURES = """
    select title_name, season_number, content_category, season_number::double as prequel_count,
        round(case when season_number > 1 then n * (season_number - 1) / season_number / (season_number - 1) end, 6) as prequel_featured_count
    from (select title_name, season_number, content_category, count(distinct reference_title_id)::double as n
        from graph where content_category = 'series' and reference_type = 'featured_in' group by 1, 2, 3)
    union all
    select p.title_name, p.season_number, p.content_category, p.n::double,
        round(case when p.n > 0 then f.n / p.n end, 6)
    from (select title_name, season_number, content_category, cast(sum(n) as bigint) as n from (
            select title_name, season_number, content_category, reference_type, count(distinct reference_title_id) as n
            from graph where content_category <> 'series' and reference_type <> 'featured_in' group by 1, 2, 3, 4)
        group by 1, 2, 3) p
    left join (select title_name, season_number, content_category, count(distinct reference_reference_title_id)::double as n
        from graph where content_category <> 'series' and reference_type <> 'featured_in'
            and reference_reference_type = 'featured_in' group by 1, 2, 3) f
        on f.title_name = p.title_name and f.season_number = p.season_number and f.content_category = p.content_category"""


@query("reference_features", sql("assets", _FEATURES, **_GRAPH), wide=("season_number",))
def reference_features(spark, d):
    rows = firstviews.reference_features(_graph(spark, d), _KEYS)
    return rows.select(*_KEYS, rnd("prequel_count").alias("prequel_count"), rnd("prequel_featured_count").alias("prequel_featured_count"))


# --- decay ---------------------------------------------------------------------------------

_DECAY = {
    "shares": """
        select *, sum(first_views) over (partition by title_id, season_number, content_category, category, tier, eff_start order by days_since_premiere)
            / nullif(sum(first_views) over (partition by title_id, season_number, content_category, category, tier, eff_start), 0) as cumpct
        from grid""",
    "curve0": """
        select category, days_since_premiere, median(cumpct) as cumpct, count(distinct title_id) as n_titles
        from shares group by 1, 2""",
    "curve": """
        select *, case when days_since_premiere = 0 then cumpct
            else cumpct - lag(cumpct) over (partition by category order by days_since_premiere) end as pct from curve0""",
}
#: Titles, daily grid and decay curve, for queries that forecast from them.
FIRST_VIEWS = {**_ASSETS, **_DECAY}
_DECAY_KEYS = ["title_id", "season_number", "content_category", "category", "tier", "effective_start_date"]


def decay_of(spark, d):
    return firstviews.decay_curve(grid_of(spark, d), _DECAY_KEYS, "category", "title_id")


@query(
    "decay_curve",
    sql(
        "ev assets",
        "select category, days_since_premiere::bigint as days_since_premiere, round(cumpct, 6) as first_views_cumpct, "
        "n_titles as title_count_training, round(pct, 6) as first_views_pct from curve",
        **_ASSETS,
        **_DECAY,
    ),
)
def decay_curve(spark, d):
    return decay_of(spark, d).select(
        "category", big("days_since_premiere").alias("days_since_premiere"), rnd("first_views_cumpct").alias("first_views_cumpct"),
        "title_count_training", rnd("first_views_pct").alias("first_views_pct"),
    )


_PREDICTED = """
    select k as title, ['Popcorn', 'Pay1', 'Specials', 'New label'][k % 4 + 1] as category,
        date '2024-03-01' + cast(k % 60 as integer) as eff_start, k * 10.0 as pred from assets"""
_SPREAD = """
    select p.title, p.category, p.pred * case when p.category = 'Popcorn' and c.pct is null then o.pct else c.pct end as views,
        p.eff_start + cast(c.days_since_premiere as integer) as day
    from p left join (select * from curve where category <> 'Popcorn') c
        on c.category = case when p.category in (select category from curve where category <> 'Popcorn')
            or p.category = 'Popcorn' then p.category else 'Pay1' end
    left join (select * from curve where category = 'Popcorn') o on o.category = p.category
        and o.days_since_premiere = c.days_since_premiere"""


@query(
    "decay_apply",
    sql(
        "ev assets",
        "select title, category, strftime(date_trunc('month', day), '%Y-%m-%d') as first_view_month, "
        "strftime(date_trunc('quarter', day), '%Y-%m-%d') as first_view_quarter, "
        "round(sum(views), 4) as first_views_pred_decay from spread group by 1, 2, 3, 4",
        **_ASSETS,
        **_DECAY,
        p=_PREDICTED,
        spread=_SPREAD,
    ),
)
def decay_apply(spark, d):
    """A curve without the special category stands for categories a model never saw."""
    curve = decay_of(spark, d)
    k = F.col("k")
    labels = F.array(*[F.lit(c) for c in ("Popcorn", "Pay1", "Specials", "New label")])
    predictions = s.assets(spark, d).select(
        k.alias("title"), F.element_at(labels, (k % 4 + 1).cast("int")).alias("category"),
        F.date_add(F.lit("2024-03-01").cast("date"), (k % 60).cast("int")).alias("effective_start_date"),
        (k * F.lit(10.0)).alias("first_views_pred"),
    )
    spread = firstviews.apply_decay(predictions, curve.where("category <> 'Popcorn'"), curve)
    months = firstviews.monthly_totals(
        spread, ["title", "category", "first_view_quarter"], "first_views_pred_decay"
    )
    return months.select(
        "title", "category", iso("first_view_month").alias("first_view_month"),
        iso("first_view_quarter").alias("first_view_quarter"), rnd("first_views_pred_decay", 4).alias("first_views_pred_decay"),
    )


_TRAIN = """
    select g.title_id, g.title_name, g.season_number, g.content_category, g.category, cast(g.tier as integer) as tier,
        cast(sum(first_views) as bigint) as first_views from grid g group by 1, 2, 3, 4, 5, 6"""


@query(
    "training_rows",
    sql(
        "ev assets",
        """
        select title_id, season_number, content_category, category, tier,
            case when category = 'Pay1' and tier = 2 then 3 when category = 'Pay1' and tier = 1 then 2 else tier end as tier_adj,
            case when content_category = 'series' then -1.0 else least(coalesce(pc, 0), 5.0) end as prequel_count,
            round(case when content_category = 'series' then -1.0 else least(coalesce(pf, 0), 20.0) end, 6) as prequel_featured_count,
            least(first_views, 1000000) as first_views,
            round(case when first_views = 0 then 0 else ln(first_views) end, 6) as first_views_log
        from t left join (select title_name as tn, season_number as sn, content_category as cc, prequel_count as pc,
            prequel_featured_count as pf from f) on tn = 'N' || title_id and sn = season_number and cc = content_category""",
        **_ASSETS,
        **{k: v for k, v in _GRAPH.items() if k != "keyed"},
        t=_TRAIN,
        f=_FEATURES,
    ),
    wide=("season_number",),
)
def training_rows(spark, d):
    rows = prepared_titles(spark, d)
    return rows.select(
        "title_id", "season_number", "content_category", "category", "tier", "tier_adj", "prequel_count",
        rnd("prequel_featured_count").alias("prequel_featured_count"), big("first_views").alias("first_views"),
        rnd("first_views_log").alias("first_views_log"),
    )


def titles_with_references(spark, d):
    """First views per title with reference features of the part that carries its number."""
    keys = ["title_id", "title_name", "season_number", "content_category", "category", "tier"]
    features = firstviews.reference_features(_graph(spark, d), _KEYS)
    named = features.withColumn("title_id", F.substring("title_name", 2, 20).cast("bigint")).drop("title_name")
    grid = grid_of(spark, d)
    totals = grid.groupBy(*keys).agg(
        F.sum("first_views").alias("first_views"), F.min("effective_start_date").alias("effective_start_date")
    )
    joined = totals.join(named, ["title_id", "season_number", "content_category"], "left").fillna(
        0.0, subset=["prequel_count", "prequel_featured_count"]
    )
    return joined.withColumn("first_views_log", log_zero_is_zero(F.col("first_views").cast("double")))


def prepared_titles(spark, d):
    return firstviews.prepared(titles_with_references(spark, d), True)
