"""Date rules. Whole-day differences count calendar boundaries; edges use microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.constants import FAR_FUTURE

DAY_US = 86_400_000_000


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def add_days(moment: Column, days: int | Column) -> Column:
    """Keeps the time of day, which ``date_add`` would drop."""
    days = F.lit(days) if isinstance(days, int) else days
    return moment + F.make_dt_interval(days=days)


def add_minutes(moment: Column, minutes: int) -> Column:
    return moment + F.make_dt_interval(mins=F.lit(minutes))


def day_ceiling(moment: Column, anchor: Column) -> Column:
    """Smallest whole n with ``moment <= anchor + n days`` (negative n allowed)."""
    gap = F.unix_micros(moment) - F.unix_micros(anchor)
    whole = gap + F.pmod(-gap, F.lit(DAY_US))
    return (whole / F.lit(DAY_US)).cast("int")


def first_public(
    theatrical: Column, linear: Column, current: Column, legacy: Column
) -> Column:
    """Cinema or broadcast date when there is one, else the first day on a platform."""
    return F.coalesce(F.least(theatrical, linear), F.least(current, legacy))


def earliest_or_far_future(*dates: Column) -> Column:
    return F.coalesce(F.least(*dates), F.lit(FAR_FUTURE).cast("timestamp"))


def age_in_years(first_public_at: Column, offered: Column, release_year: Column) -> Column:
    """Day-based age unless the calendar-year age is more than a year larger."""
    by_days = F.datediff(offered, first_public_at) / F.lit(365.0)
    by_year = F.year(offered) - release_year
    return F.when(by_days + 1 < by_year, by_year.cast("double")).otherwise(by_days)


def at_release_year(offered: Column, release_year: Column) -> Column:
    return F.when(F.year(offered) == release_year, 1).otherwise(0)


def in_sequential_release(first_offered: Column, last_offered: Column) -> Column:
    return F.when(add_days(first_offered, 28) <= last_offered, 1).otherwise(0)


def day_of_week(moment: Column) -> Column:
    """0 is Sunday."""
    return F.dayofweek(moment) - 1


def day_label(day: Column, metric: str) -> Column:
    """``day007_metric``; days before launch are passed as positive numbers."""
    return F.format_string(f"day%03d_{metric}", day.cast("int"))


def clamp_start(start: Column, floor: str) -> Column:
    return F.greatest(start, F.lit(floor).cast("timestamp"))


def is_inactive(end: Column, run_ts: Column) -> Column:
    """True once the offering ended; an unknown end counts as ended."""
    return F.when(end >= run_ts, F.lit(False)).otherwise(F.lit(True))


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def grace_expiry(
    provider: Column, expire: Column, cancel: Column, run_ts: Column, providers, days: int
) -> Column:
    """App stores report a late expiry; inside the grace period the cancel date counts."""
    in_grace = provider.isin(*providers) & (F.datediff(run_ts, expire) <= days)
    return F.when(in_grace, cancel).otherwise(expire)


def renewed_expiry(is_cancel: Column, next_start: Column, expire: Column) -> Column:
    return F.when(~is_cancel & next_start.isNotNull(), next_start).otherwise(expire)


def finished_window(days_on_platform: Column, category: Column, start: Column) -> Column:
    needed = F.when((category == "Popcorn") & (F.year(start) < 2022), 31).otherwise(90)
    return F.when(days_on_platform >= needed, 1).otherwise(0)


def iso_date(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def month_start(moment: Column) -> Column:
    return F.trunc(moment, "month")


def quarter_start(moment: Column) -> Column:
    return F.trunc(moment, "quarter")


def days_since_epoch_day(moment: Column, epoch: str) -> Column:
    return F.datediff(moment, F.lit(epoch).cast("date"))
