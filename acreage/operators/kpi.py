"""Monthly indicators: exact medians and means over dense month spines, year-over-year change, cutoff, rolling three months."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreage.functions.dates import month_range

#: Square metres in a ping, over the 10,000 in which prices are told.
PING = 3.305785
PRICES = ["median_total", "mean_total", "median_unit", "mean_unit"]
LAG_MONTHS, THRESHOLD, BASELINE_MONTHS = 3, 0.75, 12


def measures(total: str = "total_price", unit: str = "unit_price") -> list[Column]:
    """Prices as DECIMAL(18,6) before anything is derived from them, and the count."""
    price = lambda c: c.cast("decimal(18,6)")
    mean_total = F.sum(F.col(total).cast("decimal(20,0)")) / F.count(total) / F.lit(10000)
    return [
        price(F.expr(f"percentile({total}, 0.5)") / 10000.0).alias("median_total"), price(mean_total).alias("mean_total"),
        price(
            F.expr(f"percentile({unit}, 0.5)") * PING / 10000.0
        ).alias("median_unit"), price(F.avg(unit) * PING / 10000.0).alias("mean_unit"),
        F.count("*").alias("n"),
    ]


def month_spine(bounds: DataFrame, first: str = "first", last: str = "last") -> DataFrame:
    """Every month from first to last of a one-row frame."""
    return bounds.select(F.explode(month_range(F.col(first), F.col(last))).alias("month"))


def with_yoy(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Change against the same month a year before, from the stored prices. A calendar self-join, so gaps give null."""
    before = df.select(*keys, F.add_months("month", 12).alias("month"), *[F.col(c).alias(f"_{c}") for c in [*PRICES, "n"]])
    both = df.join(before, [*keys, "month"], "left")
    ratio = lambda a, b: (F.try_divide(F.col(a), F.col(b)) - 1).cast("decimal(14,8)")
    count = F.when(
        F.col("_n") != 0, (F.col("n").cast("decimal(18,0)") / F.col("_n").cast("decimal(18,0)") - 1).cast("decimal(14,8)")
    )
    return both.select(
        *keys, "month", *PRICES, "n", *[ratio(c, f"_{c}").alias(f"{c}_yoy") for c in PRICES], count.alias("n_yoy")
    )


def windowed(facts: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """Prices and counts of each month and member over the width months that end with it, without empty ones.

    Each fact goes to all the months that it counts for, so the band join is an equality and the months spread the load.
    """
    later = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda k: F.add_months("month", k))
    at = facts if width == 1 else facts.withColumn("month", F.explode(later))
    return at.groupBy(*keys, "month").agg(*measures())


def dense(measured: DataFrame, spine: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A row for each row of the spine, empty ones with count 0 and null prices."""
    return spine.join(measured, [*keys, "month"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def monthly(
    facts: DataFrame, keys: Sequence[str] = (), members: DataFrame | None = None, first: Column | None = None,
    last: Column | None = None, width: int = 1
) -> DataFrame:
    """Indicators of each month (and member) over the dense spine, each over the width months that end with it.

    Without first and last, the spine goes from the first month that has all its width months to the last one of the facts.
    """
    start, end = first if first is not None else F.add_months(
        F.min("month"), width - 1
    ), last if last is not None else F.max("month")
    spine = month_spine(facts.agg(start.alias("first"), end.alias("last")))
    if members is not None:
        spine = spine.crossJoin(members)
    return with_yoy(dense(windowed(facts, keys, width), spine, keys), keys)


def monthly_counts(facts: DataFrame, in_scope: Column) -> DataFrame:
    return facts.where(in_scope).groupBy("month").agg(F.count("*").alias("n"))


def rolling_baseline(counts: DataFrame) -> DataFrame:
    """(month, n, baseline, observed): the median count of the observed months among the twelve before; none is filled in.

    Counts are one row for each month, so the single window partition is as long as the calendar, not as the facts.
    """
    before = "over (order by month range between interval 12 month preceding and interval 1 month preceding)"
    return counts.select(
        "month", "n", F.expr(f"percentile(n, 0.5) {before}").alias("baseline"), F.expr(f"count(n) {before}").alias("observed")
    )


def cutoff(facts: DataFrame, in_scope: Column) -> DataFrame:
    """(source_max, candidate): the latest month at least LAG_MONTHS before the last one of all facts whose count in scope reaches the threshold.

    candidate is null, in its row, where no month qualifies.
    """
    scored = rolling_baseline(monthly_counts(facts, in_scope)).where("observed > 0")
    source = facts.agg(F.max("month").alias("source_max"))
    fit = scored.join(
        F.broadcast(source),
        (F.col("month") <= F.add_months("source_max", -LAG_MONTHS)) & (F.col("n") >= F.col("baseline") * THRESHOLD)
    )
    return source.join(fit.agg(F.max("month").alias("candidate")))


def effective_end(current: Column, candidate: Column) -> Column:
    """Publication moves forward only."""
    return F.greatest(current, candidate)


def rolling3(facts: DataFrame, keys: Sequence[str], members: DataFrame) -> DataFrame:
    """Indicators over a month and the two before it, from the transactions themselves, for every anchor and member."""
    return monthly(facts, keys, members, width=3)


def increment(
    stored: DataFrame, facts: DataFrame, months: Sequence[date], keys: Sequence[str] = (), members: DataFrame | None = None,
    width: int = 1
) -> DataFrame:
    """The indicators after the facts of some months have changed: only the given months are measured anew.

    Facts are filtered by their month before anything is summed, to the months that the given ones look back on, with
    literals, so that a table partitioned by month reads no other. Yearly change is taken anew from the stored prices.
    """
    days = lambda ms: [F.lit(m).cast("date") for m in ms]
    looked = sorted({back(m, k) for m in months for k in range(width)})
    spine = stored.sparkSession.createDataFrame([(m,) for m in months], "month date")
    if members is not None:
        spine = spine.crossJoin(members)
    fresh = dense(windowed(facts.where(F.col("month").isin(days(looked))), keys, width), spine, keys)
    kept = stored.where(~F.col("month").isin(days(months)))
    return with_yoy(kept.select(*keys, "month", *PRICES, "n").unionByName(fresh.select(*keys, "month", *PRICES, "n")), keys)


def back(month: date, months: int) -> date:
    """The first of the month so many months earlier."""
    at = month.year * 12 + month.month - 1 - months
    return date(at // 12, at % 12 + 1, 1)


def months_from(first: date, last: date) -> list[date]:
    return [back(first, -k) for k in range((last.year - first.year) * 12 + last.month - first.month + 1)]


def trailing(df: DataFrame, months: int, keys: Sequence[str] = ()) -> DataFrame:
    """The last so many months of each member."""
    last = df.agg(F.max("month").alias("_last"))
    return df.join(F.broadcast(last)).where(F.col("month") > F.add_months("_last", -months)).drop("_last")


def share_of_total(parts: DataFrame, total: DataFrame) -> DataFrame:
    """Each member's share of the whole's count and the ratio of its median price to the whole's."""
    whole = total.select("month", F.col("n").alias("_n"), F.col("median_total").alias("_m"))
    share = F.try_divide(F.col("n").cast("double"), F.col("_n")).cast("decimal(14,8)")
    return parts.join(whole, "month").withColumns(
        {"share": share, "price_ratio": F.try_divide("median_total", "_m").cast("decimal(14,8)")}
    ).drop("_n", "_m")


def cross_grain(fine: DataFrame, coarse: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Months (and keys) in which the counts of the fine grain do not add up to the coarse grain's."""
    added = fine.groupBy(*keys, "month").agg(F.sum("n").alias("fine"))
    both = coarse.select(*keys, "month", F.col("n").alias("coarse")).join(added, [*keys, "month"], "full")
    return both.select(
        *keys, "month", F.coalesce("fine", F.lit(0)).alias("fine"), F.coalesce("coarse", F.lit(0)).alias("coarse")
    ).where("fine <> coarse")


def ordered_first(df: DataFrame, partition: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*partition).orderBy(*order))).where("_k = 1").drop("_k")
