"""What may be published: safety rules, licence rules, caps and run guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlens.functions import addresses as A
from quorumlens.functions import constants as K
from quorumlens.operators.corroborate import Rules


def too_wide(rules: Rules = Rules()) -> Column:
    """Network wider than /22 (/48 for IPv6) that no exempt source vouches for."""
    exempt = F.arrays_overlap(
        F.col("sources"), F.array(*[F.lit(s) for s in rules.netblock_sources])
    )
    limit = F.when(F.col("family") == 4, K.WIDEST_V4).otherwise(K.WIDEST_V6)
    return F.col("is_net") & (F.col("prefix") < limit) & ~exempt


def drop_reason(rules: Rules = Rules()) -> Column:
    """First failing rule, in fixed order; NULL keeps the row.

    Expects scored rows with ``allowlisted`` from the interval lookup.
    """
    return (
        F.when(~A.is_global(), "non_global")
        .when(too_wide(rules), "too_wide")
        .when(F.col("allowlisted"), "allowlisted")
        .when(F.size("sources") == 0, "not_redistributable")
        .when(F.col("only_tagging"), "tag_only")
    )


def with_drop_reason(scored: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return scored.withColumn("drop_reason", drop_reason(rules))


def kept(judged: DataFrame) -> DataFrame:
    return judged.filter("drop_reason is null").drop("drop_reason")


def publishable(scored: DataFrame) -> DataFrame:
    return scored.filter("band <> 'withheld'")


def drop_counts(judged: DataFrame) -> DataFrame:
    """Rows dropped per tier and rule."""
    return (
        judged.filter("drop_reason is not null")
        .groupBy("tier", "drop_reason")
        .agg(F.count("*").alias("dropped"))
    )


def first_per_group(df: DataFrame, group: list[str], order: list[Column], limit: int) -> DataFrame:
    """First ``limit`` rows of each group.

    Cut per (group, salt) before the final cut, so that a group holding most of the rows is
    ranked by many tasks and only ``limit`` rows per salt reach the last one.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if c not in group]), F.lit(64))
    inner = Window.partitionBy(*group, "_salt").orderBy(*order)
    outer = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn("_salt", salt)
        .withColumn("_r", F.row_number().over(inner))
        .filter(F.col("_r") <= limit)
        .withColumn("rank", F.row_number().over(outer))
        .filter(F.col("rank") <= limit)
        .drop("_salt", "_r")
    )


def drop_examples(judged: DataFrame, limit: int = 5) -> DataFrame:
    """Up to five examples per tier and rule, in address order."""
    rows = judged.filter("drop_reason is not null").select(
        "tier", "drop_reason", *A.ADDRESS_COLUMNS
    )
    return first_per_group(rows, ["tier", "drop_reason"], A.sort_key(), limit)


def cap_benign(
    published: DataFrame,
    labels: DataFrame,
    tiers: tuple[str, ...] = ("primary", "permissive"),
    where: Column | None = None,
) -> DataFrame:
    """High -> medium for bare addresses classified benign; nothing else changes.

    ``labels`` holds (address, label); ``where`` narrows the rows that may be capped.  Adds
    ``benign_capped``.
    """
    benign = (
        labels.filter("label = 'benign'")
        .select(F.col("address").alias("indicator"))
        .distinct()
        .withColumn("_benign", F.lit(True))
    )
    hit = (
        F.coalesce(F.col("_benign"), F.lit(False))
        & ~F.col("is_net")
        & (F.col("band") == "high")
        & F.col("tier").isin(*tiers)
    )
    if where is not None:
        hit = hit & where
    return (
        published.join(benign, "indicator", "left")
        .withColumn("benign_capped", hit)
        .withColumn("band", F.when(F.col("benign_capped"), "medium").otherwise(F.col("band")))
        .drop("_benign")
    )


class ChurnExceeded(RuntimeError):
    """The high-confidence list would change more than a run may change it."""


def churn(new_high: Column, old_high: Column) -> Column:
    """Relative change of the high-confidence count; NULL without a previous one."""
    return F.when(old_high > 0, F.abs(new_high - old_high) / old_high)


def check_churn(new_high: int, old_high: int, force: bool = False) -> None:
    if old_high and not force:
        moved = abs(new_high - old_high) / old_high
        if moved > K.CHURN_LIMIT:
            raise ChurnExceeded(f"high-confidence list would move from {old_high} to {new_high}")
