"""Routing lots by risk, and what the routing costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fablens import constants as K
from fablens.functions import numbers as N


def _by_tier(p: Column, t1, t2, values: tuple[str, str, str]) -> Column:
    return F.when(N.is_unscored(p) | (p >= t1), values[0]).when(p >= t2, values[1]).otherwise(values[2])


def route_lots(scored: DataFrame, t1: float | Column, t2: float | Column = K.ELEVATED_RISK) -> DataFrame:
    """Tier, action and urgency per lot. ``t1`` is tested first; with t1 <= t2 tier 2 is empty.

    ``t1`` may be a scalar subquery, such as the threshold of a stored champion. A lot without a score (NULL or NaN) is held.
    """
    p = F.col("p")
    return scored.withColumns(
        {
            "risk_tier": _by_tier(p, t1, t2, (K.TIER_1, K.TIER_2, K.TIER_3)),
            "operational_action": _by_tier(p, t1, t2, (K.TIER_1_ACTION, K.TIER_2_ACTION, K.TIER_3_ACTION)),
            "alert_urgency": _by_tier(p, t1, t2, ("URGENT", "MEDIUM", "LOW")),
        }
    )


def operational_alerts(routed: DataFrame) -> DataFrame:
    """The alert table; it keeps the unit key so that it joins back to production."""
    return routed.select(
        "production_id",
        N.lot_code(F.col("production_id")).alias("lot_id"),
        F.round(F.col("p") * 100, 2).alias("failure_risk_pct"),
        "risk_tier",
        "operational_action",
        "alert_urgency",
        F.when(F.col("y") == 1, "DEFECT").otherwise("CONFORMING").alias("actual_quality"),
    )


def tier_summary(routed: DataFrame) -> DataFrame:
    """Lots and share per tier; the total is taken over the three tier rows."""
    counts = routed.groupBy("risk_tier").agg(F.count("*").alias("lots"))
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counts.withColumn("share_pct", N.pct(F.col("lots"), F.sum("lots").over(every), 1))


def dispatch_queue(routed: DataFrame, k: int | None = None) -> DataFrame:
    """Alerts by urgency, then risk. ``k`` keeps the head of the queue (a distributed top-k).

    Ordering comes first, so the alert texts are only built for rows that stay.
    """
    urgency = F.when(F.col("alert_urgency") == "URGENT", 1).when(F.col("alert_urgency") == "MEDIUM", 2).otherwise(3)
    queue = routed.orderBy(urgency, F.round(F.col("p") * 100, 2).desc(), "production_id")
    return operational_alerts(queue.limit(k) if k else queue)


def mitigated_cost_by_tier(routed: DataFrame) -> DataFrame:
    """Tier by actual quality, with the cost each cell carries (tier 2 carries none)."""
    return routed.groupBy(
        "risk_tier", F.when(F.col("y") == 1, "DEFECT").otherwise("CONFORMING").alias("actual_quality")
    ).agg(
        F.count("*").alias("lots"),
        F.sum(
            F.when((F.col("risk_tier") == K.TIER_3) & (F.col("y") == 1), K.SCRAP_COST)
            .when((F.col("risk_tier") == K.TIER_1) & (F.col("y") == 0), K.INSPECTION_COST)
            .otherwise(0.0)
        ).alias("cost_gbp"),
    )


def cost_of_quality_bi(alerts: DataFrame, quality: DataFrame) -> DataFrame:
    """Scrap loss, unmitigated risk, cost under routing, and the savings."""
    joined = quality.join(alerts.select("production_id", "risk_tier"), "production_id")
    missed = (F.col("risk_tier") == K.TIER_3) & F.col("is_defect")
    false_alarm = (F.col("risk_tier") == K.TIER_1) & ~F.col("is_defect")
    sums = joined.agg(
        F.sum("estimated_scrap_cost").alias("total_scrap_loss_gbp"),
        (N.count_where(F.col("is_defect")) * K.SCRAP_COST).alias("baseline_unmitigated_risk_gbp"),
        (N.count_where(missed) * K.SCRAP_COST + N.count_where(false_alarm) * K.INSPECTION_COST).alias(
            "mitigated_operational_cost_gbp"
        ),
    )
    return sums.withColumn(
        "financial_savings_gbp",
        F.col("baseline_unmitigated_risk_gbp") - F.col("mitigated_operational_cost_gbp"),
    )
