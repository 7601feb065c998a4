"""Evidence weighting: recency, severity, saturation, bands."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def moment(as_of: str | date | datetime) -> Column:
    """A run day or instant as a timestamp literal."""
    text = as_of if isinstance(as_of, str) else as_of.isoformat(sep=" ") if isinstance(
        as_of, datetime
    ) else as_of.isoformat()
    return F.lit(text).cast("timestamp")


def age_days(then: Column, now: Column) -> Column:
    """Age in (fractional) days."""
    return (F.unix_micros(now) - F.unix_micros(then)) / F.lit(86_400_000_000.0)


def recency_factor(last_seen: Column, now: Column, ttl_days: Column) -> Column:
    """Linear decay from 1.0 to 0.2 over the time to live; 1.0 where there is none."""
    decayed = F.lit(1.0) - F.greatest(F.lit(0.0), age_days(last_seen, now)) / ttl_days
    return F.when(ttl_days <= 0, F.lit(1.0)).otherwise(
        F.greatest(F.lit(K.RECENCY_FLOOR), decayed)
    )


def severity(categories: Column) -> Column:
    """Highest severity among the categories; 0.6 for unknown ones and for none."""
    table = F.create_map(*[F.lit(x) for pair in K.CATEGORY_SEVERITY.items() for x in pair])
    each = F.transform(
        categories, lambda c: F.coalesce(F.try_element_at(table, c), F.lit(K.DEFAULT_SEVERITY))
    )
    return F.coalesce(F.array_max(each), F.lit(K.DEFAULT_SEVERITY))


def vouched(evidence_stale: Column, dormant: Column) -> Column:
    """Whether anybody stands behind the evidence today."""
    return ~F.coalesce(evidence_stale, F.lit(False)) & ~F.coalesce(dormant, F.lit(False))


def freshness(last_seen: Column, now: Column, ttl_days: Column, is_vouched: Column) -> Column:
    """Recency, damped to a fifth for evidence nobody vouches for."""
    return recency_factor(last_seen, now, ttl_days) * F.when(is_vouched, 1.0).otherwise(
        K.UNVOUCHED_FACTOR
    )


def saturate(raw: Column) -> Column:
    """0..100, so that no single class can come near the top."""
    return F.lit(100.0) * (F.lit(1.0) - F.exp(-raw))


def band(open_classes: Column, restricted_classes: Column) -> Column:
    """Restricted classes may lift medium to high, never admit."""
    return (
        F.when(open_classes >= K.HIGH_CLASSES, "high")
        .when(
            open_classes >= K.MEDIUM_CLASSES,
            F.when(open_classes + restricted_classes >= K.HIGH_CLASSES, "high").otherwise("medium"),
        )
        .otherwise("withheld")
    )


def prior_level(tags: Column) -> Column:
    """Highest upstream corroboration level named in the tags, 0 if none."""
    level = F.transform(
        tags,
        lambda t: F.coalesce(
            F.regexp_extract(t, "^" + K.LEVEL_TAG_PREFIX + "(?:.*-)?([0-9]+)$", 1).try_cast("int"),
            F.lit(0),
        ),
    )
    return F.coalesce(F.array_max(level), F.lit(0))


def score_bucket(score: Column) -> Column:
    """Upstream score floored to a multiple of 25 within 0..100; NULL without a score."""
    down = F.floor(score.cast("double") / 25).cast("int") * 25
    clamped = F.least(F.lit(100), F.greatest(F.lit(0), down))
    return F.when(score.isNotNull(), clamped)
