"""Key, date, log and text expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions import dates as dt
from marquee.functions import keys as ky
from marquee.functions import metrics as mx
from marquee.functions import text as t
from marquee.suite import standins as s
from marquee.suite.registry import big, iso, query, rnd, us
from marquee.suite.standins import sql, ts


@query(
    "scalar_keys",
    sql(
        "asset_keys",
        """
        select viewable_id, season_adj as season_number_adj, coalesce(series_id || '-' || season_adj, viewable_id) as match_id,
            case when content_category = 'series' then series_id || '-' || coalesce(season_number, 1) else viewable_id end as match_id_by_category,
            viewable_id || case when content_category = 'series' then '-' || right(asset_title_long, 1) else '' end as match_id_cost,
            coalesce(series_title_long || ' S' || season_adj, asset_title_long) as title_name,
            case when series_title_long is not null then series_title_long || ' (Season ' || coalesce(season_number, 1) || ')'
                else asset_title_long end as match_title,
            case when series_id is null then 1 else 0 end as single_episode_ind,
            case when k % 5 = 0 then '0-' else '1-' end || coalesce(series_id || '-' || season_adj, viewable_id) as match_id_platform
        from asset_keys""",
    ),
    wide=("season_number_adj",),
)
def scalar_keys(spark, d):
    category, season = F.col("content_category"), F.col("season_number")
    series, asset = F.col("series_id"), F.col("viewable_id")
    adjusted = ky.season_number_adj(category, season)
    match = ky.match_id(series, adjusted, asset)
    platform = F.when(F.col("k") % 5 == 0, "legacy").otherwise("current")
    return s.assets(spark, d).select(
        "viewable_id",
        adjusted.alias("season_number_adj"),
        match.alias("match_id"),
        ky.match_id_by_category(category, series, season, asset).alias("match_id_by_category"),
        ky.match_id_from_season_title(asset, category, F.col("asset_title_long")).alias("match_id_cost"),
        ky.title_name(F.col("series_title_long"), adjusted, F.col("asset_title_long")).alias("title_name"),
        ky.match_title(F.col("series_title_long"), season, F.col("asset_title_long")).alias("match_title"),
        ky.single_episode_ind(series).alias("single_episode_ind"),
        ky.match_id_platform(platform, match).alias("match_id_platform"),
    )


@query(
    "scalar_platform",
    """
    select event_id, case when p in ('dtc', 'google', 'samsung', 'apple') and ts::date >= date '2024-01-05' then 'current'
            when p = 'amazon' and ts::date >= date '2024-01-10' then 'current'
            when p = 'roku' and ts::date >= date '2024-01-15' then 'current'
            when ts::date < date '2024-01-05' then 'legacy' end as platform_name,
        epoch_us(case when p in ('google', 'samsung') and date_diff('day', (ts + interval 3 day)::date, date '2024-01-29') <= 2
            then ts + interval 1 day else ts + interval 3 day end) as expire_us,
        epoch_us(case when event_id % 3 <> 0 and event_id % 4 = 0 then ts + interval 5 day else ts + interval 3 day end) as renewed_us
    from (select *, ['dtc', 'google', 'samsung', 'apple', 'amazon', 'roku', 'other'][user_id % 7 + 1] as p from events)
    """,
)
def scalar_platform(spark, d):
    names = F.array(*[F.lit(p) for p in ("dtc", "google", "samsung", "apple", "amazon", "roku", "other")])
    provider = F.element_at(names, (F.col("user_id") % 7 + 1).cast("int"))
    at = F.col("ts")
    expire = dt.add_days(at, 3)
    event = F.col("event_id")
    return s.table(spark, d, "events").select(
        "event_id",
        ky.subscription_platform(provider, at, s.RULES).alias("platform_name"),
        us(
            dt.grace_expiry(provider, expire, dt.add_days(at, 1), ts(s.RUN_TS), ("google", "samsung"), 2)
        ).alias("expire_us"),
        us(dt.renewed_expiry(event % 3 == 0, F.when(event % 4 == 0, dt.add_days(at, 5)), expire)).alias("renewed_us"),
    )


@query(
    "scalar_dates",
    """
    select o_orderkey, date_diff('day', o_orderdate::date, l::date) as days, epoch_us(o_orderdate + interval 28 day) as plus28_us,
        epoch_us(l - interval 1 minute) as minute_before_us, dayofweek(l) as dow,
        case when o_orderdate + interval 28 day <= l then 1 else 0 end as sequential,
        case when year(l) = 1990 + o_custkey % 12 then 1 else 0 end as at_release_year,
        round(case when date_diff('day', o_orderdate::date, l::date) / 365.0 + 1 < year(l) - (1990 + o_custkey % 12)
            then year(l) - (1990 + o_custkey % 12) else date_diff('day', o_orderdate::date, l::date) / 365.0 end, 6)::double as age,
        epoch_us(greatest(o_orderdate, timestamp '1996-01-01')) as clamped_us,
        case when l >= timestamp '1998-01-01' then 0 else 1 end as inactive,
        year(l) // 10 * 10 as decade, strftime(l, '%Y-%m-%d') as iso_date, strftime(date_trunc('month', l), '%Y-%m-%d') as month_start,
        strftime(date_trunc('quarter', l), '%Y-%m-%d') as quarter_start, quarter(l) as quarter_no, year(l) as year_no,
        date_diff('day', date '1997-05-27', l::date) as since_epoch,
        case when date_diff('day', o_orderdate::date, l::date) >= case when o_orderstatus = 'F' and year(o_orderdate) < 2022
            then 31 else 90 end then 1 else 0 end as finished
    from (select *, o_orderdate + to_days((o_custkey % 300)::integer) as l from orders)
    """,
)
def scalar_dates(spark, d):
    at = F.col("o_orderdate")
    later = dt.add_days(at, (F.col("o_custkey") % 300).cast("int"))
    release = 1990 + F.col("o_custkey") % 12
    category = F.when(F.col("o_orderstatus") == "F", "Popcorn").otherwise("Library")
    days = dt.days_between(later, at)
    return s.table(spark, d, "orders").select(
        "o_orderkey",
        big(days).alias("days"),
        us(dt.add_days(at, 28)).alias("plus28_us"),
        us(dt.add_minutes(later, -1)).alias("minute_before_us"),
        big(dt.day_of_week(later)).alias("dow"),
        dt.in_sequential_release(at, later).alias("sequential"),
        dt.at_release_year(later, release).alias("at_release_year"),
        rnd(dt.age_in_years(at, later, release)).alias("age"),
        us(dt.clamp_start(at, "1996-01-01 00:00:00")).alias("clamped_us"),
        dt.is_inactive(later, ts("1998-01-01 00:00:00")).cast("int").alias("inactive"),
        big(dt.decade(F.year(later))).alias("decade"),
        dt.iso_date(later).alias("iso_date"),
        iso(dt.month_start(later)).alias("month_start"),
        iso(dt.quarter_start(later)).alias("quarter_start"),
        big(F.quarter(later)).alias("quarter_no"),
        big(F.year(later)).alias("year_no"),
        big(dt.days_since_epoch_day(later, "1997-05-27")).alias("since_epoch"),
        dt.finished_window(days, category, at).alias("finished"),
    )


@query(
    "scalar_first_dates",
    sql(
        "assets",
        """
        select viewable_id, epoch_us(case when theatrical_release_date is null and original_linear_air_date is null
                then least(first_offered_date_current, first_offered_date_legacy)
                else least(theatrical_release_date, original_linear_air_date) end) as public_us,
            epoch_us(coalesce(least(theatrical_release_date, original_linear_air_date, first_offered_date_legacy, premiere_air_date,
                first_offered_date_linear), timestamp '2120-05-27')) as earliest_us,
            'day' || lpad((k % 28)::varchar, 3, '0') || '_percent_viewed' as label
        from assets""",
    ),
)
def scalar_first_dates(spark, d):
    return s.assets(spark, d).select(
        "viewable_id",
        us(
            dt.first_public(
                F.col("theatrical_release_date"), F.col("original_linear_air_date"),
                F.col("first_offered_date_current"), F.col("first_offered_date_legacy"),
            )
        ).alias("public_us"),
        us(
            dt.earliest_or_far_future(
                F.col("theatrical_release_date"), F.col("original_linear_air_date"), F.col("first_offered_date_legacy"),
                F.col("premiere_air_date"), F.col("first_offered_date_linear"),
            )
        ).alias("earliest_us"),
        dt.day_label(F.col("k") % 28, "percent_viewed").alias("label"),
    )


@query(
    "scalar_day_edges",
    "select event_id, ((epoch_us(ts) - epoch_us(timestamp '2024-01-15 06:00:00')) "
    "+ ((-(epoch_us(ts) - epoch_us(timestamp '2024-01-15 06:00:00'))) % 86400000000 + 86400000000) % 86400000000) // 86400000000 as n "
    "from events",
)
def scalar_day_edges(spark, d):
    n = dt.day_ceiling(F.col("ts"), ts("2024-01-15 06:00:00"))
    return s.table(spark, d, "events").select("event_id", big(n).alias("n"))


@query(
    "scalar_logs",
    """
    select event_id, round(case when v > 0 then w / v else 0 end, 6) as ratio, coalesce(v, -1) as observed,
        round(case when v is null or v < 0 then -1 else ln(v + 1) end, 6) as log1p_never,
        round(case when v > 0 then ln(v) else -100 end, 6) as log_or_100,
        round(case when v > 0 and w > 0 then ln(w / v) else -100 end, 6) as log_ratio,
        round(case when w = 0 then 0 else ln(w) end, 6) as log_zero,
        round(case when coalesce(v, 0) + 1e-10 > 0 and v is not null then ln(v + 1e-10) else -1 end, 6) as log_floor,
        round(w / 3600, 9) as hours, round(w / 1000000, 12) as millions, least(w, 100.0) as capped,
        round(ln(share / (1 - share)), 6) as logit, round(1 / (1 + exp(-share)), 6) as expit,
        round(exp(share) * exp(0.5), 6) as inverse, greatest(v, 0) as clipped,
        round(case when w + coalesce(v, 0) = 0 then null else abs(w - coalesce(v, 0)) / ((w + coalesce(v, 0)) / 2) end, 6) as smape,
        coalesce(v, 0) + w as row_sum,
        case when event_id % 5 = 0 then 56 when event_id % 3 = 0 then 28 else 14 end as widest
    from (select event_id, case when event_id % 7 = 0 then null when event_id % 11 = 0 then 0 else value - 20 end as v,
        value as w, (event_id % 99 + 1) / 101.0::double as share from events)
    """,
)
def scalar_logs(spark, d):
    event = F.col("event_id")
    rows = s.table(spark, d, "events").select(
        "event_id",
        F.when(event % 7 != 0, F.when(event % 11 == 0, 0.0).otherwise(F.col("value") - 20)).alias("v"),
        F.col("value").alias("w"),
        ((event % 99 + 1) / F.lit(101.0)).alias("share"),
    )
    v, w, share = F.col("v"), F.col("w"), F.col("share")
    z = F.coalesce(v, F.lit(0.0))
    return rows.select(
        "event_id",
        rnd(mx.guarded_ratio(w, v)).alias("ratio"),
        mx.or_never_observed(v).alias("observed"),
        rnd(mx.log1p_or_never(v)).alias("log1p_never"),
        rnd(mx.log_or_not_reached(v)).alias("log_or_100"),
        rnd(mx.log_ratio_or_not_reached(w, v)).alias("log_ratio"),
        rnd(mx.log_zero_is_zero(w)).alias("log_zero"),
        rnd(mx.log_floored(v)).alias("log_floor"),
        rnd(mx.seconds_to_hours(w), 9).alias("hours"),
        rnd(mx.to_millions(w), 12).alias("millions"),
        mx.winsorise(w, 100.0).alias("capped"),
        rnd(mx.logit(share)).alias("logit"),
        rnd(mx.expit(share)).alias("expit"),
        rnd(mx.inverse_log_ratio(share, F.lit(0.5))).alias("inverse"),
        mx.non_negative(v).alias("clipped"),
        rnd(mx.smape(w, z)).alias("smape"),
        mx.row_sum([v, w]).alias("row_sum"),
        mx.widest_window([(F.when(event % 5 == 0, w), 56), (F.when(event % 3 == 0, w), 28)], 14).alias("widest"),
    )


@query(
    "scalar_flags",
    """
    select p_partkey, (case when p_type = 'PROMO' then 1.0 when p_type = 'LARGE' then 0.0 end)::double as program_flag,
        (case when p_type = 'SMALL' then 1.0 else 0.0 end)::double as series_flag,
        case when p_name like '%bolt%' then 'special' when c in ('Popcorn', 'Pay1') then 'movies' when c = 'Specials' then 'special'
            else coalesce(case when p_size % 2 = 0 then 'series' end, 'series') end as content_category,
        case when c = 'Pay1' and tier = 2 then 3 when c = 'Pay1' and tier = 1 then 2 else tier end as tier_adj,
        case when p_retailprice / 1000 is not null then least(p_size / 10.0, p_retailprice / 1000) end as capped_hours,
        case when p_size / 10.0 > 0.9 * p_retailprice / 1000 then 1 else 0 end as completed
    from (select *, ['Popcorn', 'Pay1', 'Specials', 'Library'][p_partkey % 4 + 1] as c, p_size % 4 as tier from part)
    """,
)
def scalar_flags(spark, d):
    labels = F.array(*[F.lit(c) for c in ("Popcorn", "Pay1", "Specials", "Library")])
    category = F.element_at(labels, (F.col("p_partkey") % 4 + 1).cast("int"))
    kind = F.when(F.col("p_type") == "PROMO", "original").when(F.col("p_type") == "LARGE", "acquired").otherwise("unknown")
    title = F.when(F.col("p_name").contains("bolt"), "Harry Potter").otherwise(F.col("p_name"))
    watched, runtime = F.col("p_size") / 10.0, F.col("p_retailprice") / 1000
    return s.table(spark, d, "part").select(
        "p_partkey",
        t.program_type_flag(kind).alias("program_flag"),
        t.series_flag(F.when(F.col("p_type") == "SMALL", "series").otherwise("movies")).alias("series_flag"),
        t.first_view_category(title, category, F.when(F.col("p_size") % 2 == 0, "series")).alias("content_category"),
        mx.tier_adjusted(title, category, F.col("p_size") % 4).alias("tier_adj"),
        mx.capped_hours(watched, runtime).alias("capped_hours"),
        F.when(watched > 0.9 * runtime, 1).otherwise(0).alias("completed"),
    )


@query(
    "text_trailers",
    """
    select p_partkey, case when t like '%Space Jam: A New Legacy%' then 'Space Jam: A New Legacy'
            when t like '%Dune | Official Main%' then 'Dune' else replace(t, 'Trailer', '') end as trailer_title
    from (select p_partkey, case when p_partkey % 4 = 0 then trim(trim(split_part(l, ': Season', 1)), '"')
            else trim(split_part(split_part(split_part(l, ': Trailer', 1), 'Trailer: ', 1), ' Trailer', 1)) end as t
        from (select p_partkey, case p_partkey % 5 when 0 then '"' || p_name || '": Season 2: Trailer'
                when 1 then p_name || ': Trailer 2' when 2 then p_name || ' Trailer' when 3 then 'Dune | Official Main Trailer'
                else 'Space Jam: A New Legacy - Trailer' end as l from part))
    """,
)
def text_trailers(spark, d):
    k = F.col("p_partkey")
    long_title = (
        F.when(k % 5 == 0, F.concat(F.lit('"'), "p_name", F.lit('": Season 2: Trailer')))
        .when(k % 5 == 1, F.concat("p_name", F.lit(": Trailer 2")))
        .when(k % 5 == 2, F.concat("p_name", F.lit(" Trailer")))
        .when(k % 5 == 3, F.lit("Dune | Official Main Trailer"))
        .otherwise(F.lit("Space Jam: A New Legacy - Trailer"))
    )
    short = F.when(k % 4 == 0, "Season 2").otherwise("Clip")
    return s.table(spark, d, "part").select(
        "p_partkey", t.trailer_title_final(t.trailer_title(short, long_title)).alias("trailer_title")
    )


@query(
    "text_titles",
    """
    select p_partkey, regexp_replace(title, ' S[0-9]+$', '') as no_season, split_part(title, ' S', 1) as before_mark,
        case when c = '-' then p_name
            when c = 'LOVECRAFT' then 'lovecraft country' when c = 'PLOT AGAINST AMERICA' then 'the plot against america'
            when c = 'FRESH PRINCE REUNION' then 'the fresh prince of bel-air reunion' when c = 'FLIGHT ATTENDANT' then 'the flight attendant'
            when c = 'FRIENDS (REUNION SPECIAL)' then 'friends: the reunion' else c end as campaign_title,
        case when f = 'BARRY LYNDON' then 'Barry Lyndon' when f = 'In The Heights' then 'In the Heights' else f end as corrected,
        replace(replace(p_name || ' | ' || p_type, ' |', '|'), '| ', '|') as spaced, right(p_brand, 2) as tail,
        length(p_name) as len, substr(p_name, 1, 4) as head
    from (select *, p_name || case when p_partkey % 3 = 0 then ' S' || p_size when p_partkey % 3 = 1 then ' Sx' else '' end as title,
            ['LOVECRAFT', 'PLOT AGAINST AMERICA', 'FRESH PRINCE REUNION', 'FLIGHT ATTENDANT', 'FRIENDS (REUNION SPECIAL)', '-', 'Other'][p_partkey % 7 + 1] as c,
            ['BARRY LYNDON', 'In The Heights', 'Barry'][p_partkey % 3 + 1] as f from part)
    """,
)
def text_titles(spark, d):
    k = F.col("p_partkey")

    def pick(values, n):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (k % n + 1).cast("int"))

    title = F.concat(
        "p_name",
        F.when(k % 3 == 0, F.concat(F.lit(" S"), F.col("p_size").cast("string"))).when(k % 3 == 1, " Sx").otherwise(""),
    )
    campaigns = ("LOVECRAFT", "PLOT AGAINST AMERICA", "FRESH PRINCE REUNION", "FLIGHT ATTENDANT", "FRIENDS (REUNION SPECIAL)", "-", "Other")
    return s.table(spark, d, "part").select(
        "p_partkey",
        t.without_season(title).alias("no_season"),
        t.before_season_mark(title).alias("before_mark"),
        t.campaign_title(pick(campaigns, 7), F.col("p_name")).alias("campaign_title"),
        t.corrected_title(pick(("BARRY LYNDON", "In The Heights", "Barry"), 3)).alias("corrected"),
        t.spaced_genres(F.concat_ws(" | ", "p_name", "p_type")).alias("spaced"),
        F.right("p_brand", F.lit(2)).alias("tail"),
        big(F.length("p_name")).alias("len"),
        F.substring("p_name", 1, 4).alias("head"),
    )
