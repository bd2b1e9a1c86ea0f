"""Subscription periods per user from store receipts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.constants import EXPIRY_GRACE_DAYS, GRACE_PROVIDERS, PROVIDERS
from marquee.functions.dates import grace_expiry, renewed_expiry
from marquee.functions.keys import (
    DEFAULT_PLATFORM_RULES,
    LEGACY_PLATFORM,
    PlatformRule,
    subscription_platform,
)
from marquee.operators.intervals import chain_periods, merge_intervals
from marquee.operators.segments import DEFAULT_LIMIT, SkewLimit

SESSION_KEYS = ("user_id", "provider", "platform_name", "is_trial")


def subscription_periods(
    receipts: DataFrame,
    identity: DataFrame,
    run_ts: Column,
    rules: Sequence[PlatformRule] = DEFAULT_PLATFORM_RULES,
    products: Sequence[str] | None = None,
    legacy: str = LEGACY_PLATFORM,
) -> DataFrame:
    """Receipts with platform, trial flag and corrected expiry, resolved to users.

    ``identity`` maps ``provider_user_id`` to ``user_id``; unresolved receipts and
    those without a platform are left out.
    """
    paid = receipts.where(
        (F.col("subscription_type") == "SVOD")
        & (F.col("country_code") == "US")
        & F.col("provider").isin(*PROVIDERS)
    )
    if products is not None:
        paid = paid.where(F.col("product_code").isin(*products))
    expire = grace_expiry(
        F.col("provider"),
        F.col("subscription_expire_date"),
        F.col("subscription_cancel_date"),
        run_ts,
        GRACE_PROVIDERS,
        EXPIRY_GRACE_DAYS,
    )
    periods = paid.select(
        "provider_user_id",
        "provider",
        F.when(F.col("free_paid_ind") == "trial", 1).otherwise(0).alias("is_trial"),
        subscription_platform(
            F.col("provider"), F.col("subscription_start_date"), rules, legacy
        ).alias("platform_name"),
        F.col("subscription_start_date").alias("starts_at"),
        renewed_expiry(F.col("is_cancel"), F.col("next_start"), expire).alias("ends_at"),
    ).where(F.col("platform_name").isNotNull())
    users = identity.where(F.col("user_id").isNotNull()).select("provider_user_id", "user_id")
    return periods.join(users, "provider_user_id").drop("provider_user_id")


def subscription_sessions(
    periods: DataFrame, max_gap_seconds: int = 0, limit: SkewLimit = DEFAULT_LIMIT
) -> DataFrame:
    """Renewals chained into sessions per user, provider, platform and trial state."""
    return chain_periods(
        periods, SESSION_KEYS, "starts_at", "ends_at", max_gap_seconds, limit
    )


def active_islands(
    sessions: DataFrame, platform: str | None = None, limit: SkewLimit = DEFAULT_LIMIT
) -> DataFrame:
    """Disjoint subscribed spans per user, on one platform or on any."""
    if platform is not None:
        sessions = sessions.where(F.col("platform_name") == platform)
    return merge_intervals(sessions, ["user_id"], "starts_at", "ends_at", limit)
