"""Retention, RFM segments and repurchase, one row per user before anything else."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import clock
from footfall.functions.labels import REPURCHASE_BUCKETS, SEGMENT_LABELS
from footfall.functions.measures import amount, having, is_summary, percent, ratio
from footfall.operators.cleaning import DATE_END
from footfall.schemas import conform


def active_days(rel: DataFrame) -> DataFrame:
    """Distinct (user_id, day) pairs, day as a number; stored user-days are distinct already."""
    days = rel.select("user_id", clock.day_number(F.col("event_date")).alias("day"))
    return days if is_summary(rel) else days.distinct()


def retention(
    rel: DataFrame,
    offsets: Sequence[int] = (1, 2, 3),
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Per first active day: new users and the percentage active again exactly n days later.

    Days after the end of the data count as not active (0, not null). The first day is a
    window minimum over a user's distinct days, so one pass replaces a self-join per offset.
    """
    first = F.min("day").over(Window.partitionBy("user_id"))
    days = active_days(clock.in_date_range(rel, start, end)).withColumn("first_day", first)
    age = F.col("day") - F.col("first_day")
    cohorts = days.groupBy("first_day").agg(
        F.count_if(age == 0).alias("new_users"),
        *(F.count_if(age == n).alias(f"returned_{n}") for n in offsets),
    )
    return cohorts.select(
        clock.day_text(F.col("first_day")).alias("first_date"),
        "new_users",
        *(
            percent(F.col(f"returned_{n}"), F.col("new_users")).alias(f"day_{n}")
            for n in offsets
        ),
    ).orderBy("first_date")


def user_rfm(
    rel: DataFrame,
    end: str = DATE_END,
    cart_weight: float | str | Decimal = "0.3",
    labels: Sequence[str] = SEGMENT_LABELS,
) -> DataFrame:
    """Recency, frequency and monetary value of every buyer, scored against the medians.

    Recency scores 3 up to the median, 2 up to twice the median, else 1. Frequency and monetary
    value score 3 from twice the median, 2 from the median, else 1. A median that is missing
    falls back to 1, as does a frequency or monetary median of 0. ``labels`` holds one name per
    combination of high and low scores, recency-frequency-monetary high first.

    The three medians are exact: the smallest value that half of the buyers do not exceed. They
    come from one aggregation and enter as a scalar subquery, without a trip through the driver.
    It counts buyers per distinct value, and there are few of those: days, and values whose sum is
    at most the number of events, so their number grows with the root of it. Carts are weighted
    in decimal so that the value is exact.
    """
    bought, carted = amount(rel, "buy"), amount(rel, "cart")
    buyers = (
        having(rel, "buy", "cart")
        .groupBy("user_id")
        .agg(
            F.max(F.when(bought > 0, clock.day_number(F.col("event_date")))).alias("last_day"),
            F.sum(bought).alias("frequency"),
            F.sum(carted).alias("carts"),
        )
        .filter(F.col("frequency") > 0)
    )
    value = F.col("frequency") + F.col("carts") * F.lit(Decimal(str(cart_weight)))
    measured = buyers.select(
        "user_id",
        (clock.day_number(F.lit(end)) - F.col("last_day")).alias("recency"),
        "frequency",
        F.round(value, 2).cast("double").alias("monetary"),
    )
    medians = measured.agg(
        F.struct(
            *(
                F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {c})").alias(c)
                for c in ("recency", "frequency", "monetary")
            )
        )
    ).scalar()
    r, f, m = (F.col("median")[c] for c in ("recency", "frequency", "monetary"))
    r = F.coalesce(r, F.lit(1))
    f, m = (F.when(x > 0, x).otherwise(F.lit(1)) for x in (f, m))

    def at_most(c, limit):
        return F.when(c <= limit, 3).when(c <= limit * 2, 2).otherwise(1)

    def at_least(c, limit):
        return F.when(c >= limit * 2, 3).when(c >= limit, 2).otherwise(1)

    scored = measured.withColumn("median", medians).withColumns(
        {
            "r_score": at_most(F.col("recency"), r),
            "f_score": at_least(F.col("frequency"), f),
            "m_score": at_least(F.col("monetary"), m),
        }
    )
    low = {c: (F.col(c) < 2).cast("int") for c in ("m_score", "r_score", "f_score")}
    place = low["m_score"] * 4 + low["r_score"] * 2 + low["f_score"] + 1
    segment = F.element_at(F.array(*(F.lit(x) for x in labels)), place)
    return conform(scored.withColumn("segment", segment), "ads.user_rfm")


def rfm_summary(rfm: DataFrame) -> DataFrame:
    """Users and average recency, frequency and monetary value per segment."""
    users = F.count("*")
    exact_value = F.sum(F.col("monetary").cast("decimal(18,2)"))
    return conform(
        rfm.groupBy("segment").agg(
            users.alias("user_count"),
            ratio(F.sum("recency"), users, 2).alias("avg_recency"),
            ratio(F.sum("frequency"), users, 2).alias("avg_frequency"),
            F.round(exact_value / users, 2).alias("avg_monetary"),
        ),
        "ads.rfm_summary",
    ).orderBy(F.desc("user_count"), "segment")


def repurchase_distribution(
    rel: DataFrame,
    buckets: Sequence[tuple[str, int, int | None]] = REPURCHASE_BUCKETS,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Buyers by number of purchases: users, purchases and the share of either, per bucket.

    ``buckets`` lists (label, fewest, most) in order; the last one is open-ended.
    """
    rel = clock.in_date_range(rel, start, end)
    buyers = having(rel, "buy").groupBy("user_id").agg(F.sum(amount(rel, "buy")).alias("times"))
    order = F.lit(len(buckets))
    for i in range(len(buckets) - 1, 0, -1):
        order = F.when(F.col("times") <= buckets[i - 1][2], i).otherwise(order)
    counted = (
        buyers.groupBy(order.alias("bucket_order"))
        .agg(F.count("*").alias("user_count"), F.sum("times").alias("total_buy"))
    )
    everyone = Window.partitionBy()  # one row per bucket by now
    names = F.array(*(F.lit(name) for name, _, _ in buckets))
    return conform(
        counted.withColumns(
            {
                "buy_times_bucket": F.element_at(names, F.col("bucket_order")),
                "user_ratio": percent(
                    F.col("user_count"), F.sum("user_count").over(everyone)
                ),
                "buy_contribution": percent(
                    F.col("total_buy"), F.sum("total_buy").over(everyone)
                ),
            }
        ),
        "ads.repurchase_distribution",
    ).orderBy("bucket_order")
