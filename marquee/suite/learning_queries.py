"""Folds, resampling, models and forecasts."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.constants import HOURS_WINDOW_NAMES
from marquee.functions.metrics import unit_hash
from marquee.operators.joins import new_rows
from marquee.plans import forecast, learning
from marquee.session import scratch_path, stored
from marquee.suite import standins as s
from marquee.suite.firstview_queries import FIRST_VIEWS, RUN, decay_of, titles_with_references
from marquee.suite.audience_queries import HOURS, _hours_share
from marquee.suite.registry import big, query, rnd, us


# --- folds and sampling ----------------------------------------------------------------



FOLDS = {
    "newest": "select max(o_orderdate) as m from orders where o_orderstatus = 'F'",
    "recent": "select epoch_us(o_orderdate)::double as t from orders, newest where o_orderdate >= m - interval 180 day",
    "edges": "select unnest(generate_series(0, 5)) as fold, quantile_cont(t, [0, 1/6, 2/6, 3/6, 4/6, 5/6, 1]) as q from recent",
    "b": "select fold, q[fold + 1]::bigint as lo, q[fold + 2]::bigint - 1000000 as hi from edges",
    "f": "select fold, lo, hi, min(epoch_us(o_orderdate)) - 28 * 86400000000 as cut from b join orders "
    "on epoch_us(o_orderdate) between lo and hi group by 1, 2, 3",
}
_FOLDS = "with " + ", ".join(f"{name} as ({body})" for name, body in FOLDS.items()) + " "


def bounds_of(spark, d):
    """Orders as launches; those of status F are on the current platform."""
    orders = s.table(spark, d, "orders").select("o_orderdate", "o_orderstatus")
    return learning.fold_bounds(orders, "o_orderdate", 6, current=F.col("o_orderstatus") == "F")


@query("time_split", _FOLDS + "select fold, lo as lower_us, hi as upper_us, cut as train_before_us from f")
def time_split(spark, d):
    return bounds_of(spark, d).select(
        big("fold").alias("fold"), us("lower").alias("lower_us"), us("upper").alias("upper_us"),
        us("train_before").alias("train_before_us"),
    )


@query(
    "time_split_sizes",
    _FOLDS
    + """select fold, count(*) filter (epoch_us(o_orderdate) < cut) as n_train,
        count(*) filter (epoch_us(o_orderdate) between lo and hi) as n_test from f, orders group by 1""",
)
def time_split_sizes(spark, d):
    orders = s.table(spark, d, "orders").select("o_orderdate")
    sizes = learning.fold_sizes(orders, bounds_of(spark, d), "o_orderdate")
    return sizes.select(big("fold").alias("fold"), big("n_train").alias("n_train"), big("n_test").alias("n_test"))


def hash_sql(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::bigint / 4294967296.0"


@query(
    "unit_hash",
    f"select doc_id, round({hash_sql("'seed|' || doc_id")}, 9)::double as u from documents",
)
def unit_hash_query(spark, d):
    return s.table(spark, d, "documents").select("doc_id", rnd(unit_hash(F.col("doc_id"), seed="seed"), 9).alias("u"))


@query(
    "mask",
    f"""select doc_id, case when {hash_sql("'242|' || doc_id || '|n_chars'")} >= 0.1 then n_chars end as n_chars,
        case when {hash_sql("'242|' || doc_id || '|source'")} >= 0.1 then source end as source from documents""",
)
def mask(spark, d):
    rows = s.table(spark, d, "documents").select("doc_id", "n_chars", "source")
    return learning.mask_features(rows, "doc_id", ["n_chars", "source"])


_STRATA = f"""
    with r as (select p_partkey, case when p_partkey % 17 <> 0 then p_size % 5 end as tier,
            case when p_type = 'PROMO' then 'Popcorn' when p_type <> 'SMALL' then p_type end as category,
            coalesce(case when p_partkey % 13 <> 0 then date '2024-01-01' - (p_partkey % 300)::integer end
                >= date '{RUN}' - 120, false) as recent from part),
        sp as (select *, coalesce(category = 'Popcorn', false) as special from r),
        sz as (select *, count(*) over (partition by tier, special, recent) as n,
            count(*) over (partition by special, recent) as ns,
            (select count(*) from r where tier = 3) as t3 from sp),
        rate as (select *, case when special then round(round(t3 * case when recent then 0.75 else 0.25 end) * case when recent then 0.3 else 0.2 end) / ns
            when tier in (0, 1, 2) then round(t3 * case when recent then 0.75 else 0.25 end) / n
            when tier = 3 then 1.0 else 0.0 end as rate from sz),
        c as (select *, floor(rate)::integer + case when {hash_sql("'58|' || p_partkey")} < rate - floor(rate) then 1 else 0 end as copies from rate)
"""


@query("resample", _STRATA + "select p_partkey, tier, category, copies from c where copies > 0")
def resample(spark, d):
    rows = s.table(spark, d, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 17 != 0, F.col("p_size") % 5).alias("tier"),
        F.when(F.col("p_type") == "PROMO", "Popcorn").when(F.col("p_type") != "SMALL", F.col("p_type")).alias("category"),
        F.when(
            F.col("p_partkey") % 13 != 0,
            F.date_sub(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 300).cast("int")),
        ).alias("effective_start_date"),
    )
    drawn = learning.resample(rows, "p_partkey", RUN)
    return drawn.groupBy("p_partkey", "tier", "category").agg(F.max("copy").alias("copies"))


@query(
    "evaluate",
    """
    with m as (select o_orderpriority, avg(o_totalprice) as p from orders group by 1),
        e as (select o_orderstatus, abs(p - o_totalprice) as ae, abs(p - o_totalprice) / ((p + o_totalprice) / 2) as sm
            from orders join m using (o_orderpriority))
    select round(avg(sm), 6) as smape_all, round(avg(sm) filter (o_orderstatus = 'F'), 6) as smape_original,
        round(avg(ae), 3) as mae_all, round(avg(ae) filter (o_orderstatus = 'F'), 3) as mae_original, count(*) as n_rows from e
    """,
)
def evaluate(spark, d):
    orders = s.table(spark, d, "orders").select("o_orderpriority", "o_orderstatus", "o_totalprice")
    means = orders.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("prediction"))
    scored = orders.join(means, "o_orderpriority")
    row = learning.evaluate(scored, "prediction", "o_totalprice", F.col("o_orderstatus") == "F")
    return row.select(
        rnd("smape_all").alias("smape_all"), rnd("smape_original").alias("smape_original"),
        rnd("mae_all", 3).alias("mae_all"), rnd("mae_original", 3).alias("mae_original"), "n_rows",
    )


# --- models: results depend on the learner, so rows only ---------------------------------


def _title_rows(spark, d):
    """Orders as titles: price from date, status and line totals."""
    lines = s.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount"), F.count(F.lit(1)).cast("double").alias("lines")
    )
    orders = s.table(spark, d, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", F.log("o_totalprice").alias("label"),
        F.datediff("o_orderdate", F.lit("1995-01-01").cast("date")).cast("double").alias("age"),
    )
    return stored(orders.join(lines, "o_orderkey", "left"))


_NUMERIC = ["quantity", "discount", "lines", "age"]
_CATEGORY = ["o_orderstatus", "o_orderpriority"]


@query("train_linear")
def train_linear(spark, d):
    rows = _title_rows(spark, d)
    stages = learning.feature_stages(_NUMERIC, _CATEGORY, one_hot=True)
    scored = learning.fit(rows, stages, learning.linear("label")).transform(rows)
    return scored.select("o_orderkey", "label", "prediction")


@query(
    "train_linear_check",
    """select round(regr_slope(ln(o_totalprice), age), 7) as slope, round(regr_intercept(ln(o_totalprice), age), 5) as intercept
        from (select o_totalprice, date_diff('day', date '1995-01-01', o_orderdate::date) as age from orders)""",
)
def train_linear_check(spark, d):
    """One numeric input: the fitted line is the least-squares line."""
    model = learning.fit(_title_rows(spark, d), learning.feature_stages(["age"]), learning.linear("label")).stages[-1]
    line = [(float(model.coefficients[0]), float(model.intercept))]
    rows = spark.createDataFrame(line, "slope double, intercept double")
    return rows.select(rnd("slope", 7).alias("slope"), rnd("intercept", 5).alias("intercept"))


@query("elastic_net_check", "select 4::bigint as n_inputs, 0::bigint as violations")
def elastic_net_check(spark, d):
    """Optimality of the penalised fit: the slope of the loss at each input against its penalty."""
    alpha, share = 0.01, 0.5
    rows = _title_rows(spark, d)
    model = learning.fit(rows, learning.feature_stages(_NUMERIC), learning.elastic_net("label", alpha, share))
    fitted = model.stages[-1]
    scored = model.transform(rows).withColumn("r", F.col("label") - F.col("prediction"))
    slopes = scored.select(vector_to_array("features").alias("x"), "r").agg(
        *[F.avg(F.get("x", i) * F.col("r")).alias(f"g{i}") for i in range(len(_NUMERIC))]
    ).first()
    wrong = 0
    for g, w in zip(slopes, fitted.coefficients):
        left = g - alpha * (1 - share) * w
        limit = alpha * share
        wrong += abs(left) > limit + 1e-3 if w == 0 else abs(left - limit * (1 if w > 0 else -1)) > 1e-3
    return spark.createDataFrame([(len(_NUMERIC), int(wrong))], "n_inputs long, violations long")


@query(
    "cross_predict_check",
    _FOLDS
    + """select o_orderkey, fold, round(o_totalprice, 2) as target, true as usable from f join orders
        on epoch_us(o_orderdate) between lo and hi where (select min(epoch_us(o_orderdate)) from orders) < cut""",
)
def cross_predict_check(spark, d):
    """Every title of a fold is scored once, by a linear model, over the six published folds."""
    rows = _title_rows(spark, d)
    scored = learning.cross_predict(
        rows, bounds_of(spark, d), "o_orderdate", learning.feature_stages(_NUMERIC, _CATEGORY, one_hot=True),
        learning.linear("label"), F.exp,
    )
    usable = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.col("prediction") > 0)
    return scored.select(
        "o_orderkey", big("fold").alias("fold"), rnd(F.exp("label"), 2).alias("target"), usable.alias("usable")
    )


@query("train_elastic_net")
def train_elastic_net(spark, d):
    rows = _title_rows(spark, d)
    stages = learning.feature_stages(_NUMERIC, _CATEGORY, one_hot=True)
    scored = learning.fit(rows, stages, learning.elastic_net("label")).transform(rows)
    return scored.select("o_orderkey", "label", "prediction")


@query("monotone_calibration")
def monotone_calibration(spark, d):
    rows = _title_rows(spark, d).fillna(0.0, subset=["quantity"])
    scored = learning.fit(rows, learning.feature_stages(_NUMERIC), learning.linear("label")).transform(rows)
    return learning.monotone_calibration(scored, "label", "quantity").select("o_orderkey", "calibrated")


@query("monotone_check", "select count(*) as n_rows, 0::bigint as falls from orders")
def monotone_check(spark, d):
    """Calibrated values never fall while the signal rises."""
    rows = _title_rows(spark, d).fillna(0.0, subset=["quantity"])
    scored = learning.fit(rows, learning.feature_stages(_NUMERIC), learning.linear("label")).transform(rows)
    steps = learning.monotone_calibration(scored, "label", "quantity").groupBy("quantity").agg(
        F.min("calibrated").alias("low"), F.max("calibrated").alias("high"), F.count("*").alias("n")
    )
    # one row per distinct quantity
    before = F.max("high").over(Window.orderBy("quantity").rowsBetween(Window.unboundedPreceding, -1))
    return steps.withColumn("before", before).agg(
        F.sum("n").alias("n_rows"), F.count_if(F.col("low") < F.col("before") - 1e-9).alias("falls")
    )


@query("model_roundtrip")
def model_roundtrip(spark, d):
    rows = _title_rows(spark, d)
    model = learning.fit(rows, learning.feature_stages(_NUMERIC), learning.linear("label"))
    path = scratch_path(spark) + "/model"
    learning.save_model(model, path)
    return learning.load_model(path).transform(rows).select("o_orderkey", "prediction")


@query("model_roundtrip_check", "select count(*) as n_rows, 0::bigint as differing from orders")
def model_roundtrip_check(spark, d):
    """A restored model predicts what the saved one does."""
    rows = _title_rows(spark, d)
    model = learning.fit(rows, learning.feature_stages(_NUMERIC), learning.linear("label"))
    path = scratch_path(spark) + "/model"
    learning.save_model(model, path)
    first = model.transform(rows).select("o_orderkey", F.col("prediction").alias("first"))
    both = learning.load_model(path).transform(rows).join(first, "o_orderkey")
    return both.agg(
        F.count("*").alias("n_rows"), F.count_if(~F.col("prediction").eqNullSafe(F.col("first"))).alias("differing")
    )


# --- 52-week share ----------------------------------------------------------------------


def _share_features(spark, d):
    """Parts as titles: four sources besides the hours shares, each lacking some titles."""
    k = F.col("p_partkey")
    part = s.table(spark, d, "part")
    items = s.table(spark, d, "lineitem").withColumnRenamed("l_partkey", "match_id")
    orders = s.table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    metadata = part.where(k % 13 != 0).select(
        k.alias("match_id"),
        (F.col("p_size") % 4).alias("season_number_adj"),
        F.when(k % 3 == 0, "original").when(k % 3 == 1, "acquired").otherwise("unknown").alias("program_type"),
        F.when(F.col("p_type") == "PROMO", "movies").otherwise("series").alias("content_category"),
        (k % 2).alias("single_episode_ind"),
        (F.col("p_size") % 2).alias("in_sequantial_releasing_period"),
        (F.col("p_size") % 5 == 0).cast("int").alias("at_release_year"),
        (k % 7 + 1).alias("dayofweek_earliest_date"),
        (F.col("p_retailprice") / 1000).alias("total_hours"),
        (F.lit(2020) - F.col("p_size") % 5).alias("prod_release_year"),
        (F.col("p_size") / 10).alias("title_age_approx"),
    )
    genres = part.select(
        k.alias("match_id"),
        F.when(k % 11 != 0, F.concat(F.lower("p_type"), F.lit(" | "), F.split("p_name", " ")[0])).alias("wm_enterprise_genres_agg"),
    )
    cost = items.where("l_returnflag = 'A'").groupBy("match_id").agg(
        F.avg("l_extendedprice").alias("content_cost"), F.log1p(F.sum("l_tax")).alias("ln_total_media_cost_pre_launch")
    )
    offers = items.select("l_orderkey", "match_id", "l_shipdate").join(orders, "l_orderkey").groupBy("match_id").agg(
        F.min(F.datediff("l_shipdate", "o_orderdate")).alias("min_days_since_offered"),
        F.min("o_orderdate").alias("earliest_offered_timestamp"),
    )
    recent = part.where("p_type = 'PROMO'").select(k.alias("match_id"), F.lit(364).alias("window"))
    shortened = new_rows(_hours_share(spark, d), recent, ["match_id", "window"])
    return stored(forecast.share_features(shortened, [metadata, genres, cost, offers], "1995-01-01"))


_SHARE = {
    **HOURS,
    "short": "select * from share where not (window_days = 364 and match_id in (select p_partkey from part where p_type = 'PROMO'))",
    "hp": "select match_id, "
    + ", ".join(f"max(score) filter (window_days = {w}) as {c}" for w, c in HOURS_WINDOW_NAMES.items())
    + " from short group by 1",
    "cost": "select l_partkey as match_id, avg(l_extendedprice) as content_cost, ln(1 + sum(l_tax)) as media from lineitem "
    "where l_returnflag = 'A' group by 1",
    "offered": "select l_partkey as match_id, min(date_diff('day', o_orderdate::date, l_shipdate::date)) as least, min(o_orderdate) as first "
    "from lineitem join orders on o_orderkey = l_orderkey group by 1",
    "inputs": """
        select hp.*, p_size % 4 as season_number_adj, case p_partkey % 3 when 0 then 1.0 when 1 then 0.0 end as is_original,
            case when p_type = 'PROMO' or p_partkey % 13 = 0 then 0.0 else 1.0 end as is_series, p_partkey % 2 as single_episode_ind,
            p_size % 2 as in_sequantial_releasing_period, (p_size % 5 = 0)::integer as at_release_year,
            p_partkey % 7 + 1 as dayofweek_earliest_date, p_retailprice / 1000 as total_hours, 2020 - p_size % 5 as prod_release_year,
            p_size / 10 as title_age_approx, content_cost, media as ln_total_media_cost_pre_launch, least as min_days_since_offered,
            date_diff('day', date '1995-01-01', first::date) as launch_time, p_partkey % 13 = 0 as gone,
            case when p_partkey % 11 = 0 then 'nan' else lower(p_type) || '|' || split_part(p_name, ' ', 1) end as genres
        from hp join part on p_partkey = hp.match_id left join cost using (match_id) left join offered using (match_id)
        where hourspct7d is not null and hourspct14d is not null""",
}
_META_INPUTS = (
    "season_number_adj", "is_original", "single_episode_ind", "in_sequantial_releasing_period", "at_release_year",
    "dayofweek_earliest_date", "total_hours", "prod_release_year", "title_age_approx",
)
_OTHER_INPUTS = ("is_series", "content_cost", "ln_total_media_cost_pre_launch", "min_days_since_offered", "launch_time")


@query(
    "share_inputs",
    s.sql(
        "",
        "select match_id, "
        + ", ".join(
            f"round(case when {c} > 0 and {c} < 100 then ln({c} / 100 / (1 - {c} / 100)) end, 6)::double as logit_{c}"
            for c in HOURS_WINDOW_NAMES.values()
        )
        + ", "
        + ", ".join(f"case when not gone then round({c}, 6)::double end as {c}" for c in _META_INPUTS)
        + ", "
        + ", ".join(f"round({c}, 6)::double as {c}" for c in _OTHER_INPUTS)
        + ", array_to_string(list_sort(list_distinct(string_split(genres, '|'))), ';') as genres from inputs",
        **_SHARE,
    ),
)
def share_inputs(spark, d):
    rows = _share_features(spark, d)
    number = lambda c: F.round(F.col(c).cast("double"), 6).alias(c)
    logits = [f"logit_{c}" for c in HOURS_WINDOW_NAMES.values()]
    return rows.select(
        "match_id", *map(number, logits), *map(number, _META_INPUTS), *map(number, _OTHER_INPUTS),
        F.array_join("genres", ";").alias("genres"),
    )


_SHARE_TRIALS: dict[tuple, str] = {}  # the trials of a process, read again by the check below


@query("share_forecast")
def share_forecast(spark, d):
    """52-week share of titles without a full year: 100 draws over ten folds on the others."""
    key = (spark.sparkContext.applicationId, d)
    path = _SHARE_TRIALS.setdefault(key, scratch_path(spark))
    return forecast.share_forecast(_share_features(spark, d), "2024-01-01", limit=400, path=path)


@query(
    "share_forecast_check",
    s.sql(
        "",
        """select match_id, '2024-01-01' as prediction_date, true as in_range, case when hourspct26w is not null then 182
            when hourspct13w is not null then 91 when hourspct8w is not null then 56 when hourspct28d is not null then 28
            when hourspct21d is not null then 21 else 14 end as window_days
            from inputs where hourspct52w is null and (select count(*) from inputs where hourspct52w > 0 and hourspct52w < 100) > 0""",
        **_SHARE,
    ),
)
def share_forecast_check(spark, d):
    rows = share_forecast(spark, d)
    inside = F.coalesce(F.col("predicted_hourspct").between(0, 100), F.lit(False))
    return rows.select("match_id", "prediction_date", inside.alias("in_range"), "window_days")


FORECAST_RUN = "2024-04-10"  # titles of January are old enough to learn from by then


@query("first_view_forecast")
def first_view_forecast(spark, d):
    titles = stored(titles_with_references(spark, d))
    model = forecast.fit_first_views(titles, "title_id", FORECAST_RUN)
    curve = stored(decay_of(spark, d))
    future = titles.withColumn("effective_start_date", F.date_add("effective_start_date", 60))
    return forecast.first_view_forecast(model, future, curve, curve, FORECAST_RUN)


@query(
    "first_view_forecast_check",
    s.sql(
        "ev assets",
        """
        select t.title_name, t.season_number::bigint as season_number, t.content_category, t.category, t.tier::bigint as tier,
            strftime(date_trunc('month', s + cast(c.days_since_premiere as integer)), '%Y-%m-%d') as first_view_month,
            sum(pct) > 1e-9 as positive
        from (select title_id, title_name, season_number, content_category, category, tier, min(eff_start) + 60 as s from grid group by 1, 2, 3, 4, 5, 6) t
        left join curve c on c.category = case when t.category in (select category from curve) or t.category = 'Popcorn' then t.category else 'Pay1' end
        group by t.title_id, 1, 2, 3, 4, 5, 6""",
        **FIRST_VIEWS,
    ),
)
def first_view_forecast_check(spark, d):
    """Every future title in every month that its curve reaches, with a positive forecast where
    the curve has views. Titles of one name are told apart by nothing else than their rows."""
    rows = first_view_forecast(spark, d)
    return rows.select(
        "title_name", big("season_number").alias("season_number"), "content_category", "category", big("tier").alias("tier"),
        F.date_format("first_view_month", "yyyy-MM-dd").alias("first_view_month"), (F.col("first_views_pred_decay") > 1e-7).alias("positive"),
    )
