"""Data-quality profiling: each summary is one aggregation over the whole table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreage.functions.numeric import WHOLE, close

#: Percentiles: pieces of values between a number and its double, and of each piece in which a share ends.
OCTAVE, EVEN = 256, 4096


def numeric_quality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, rows, missing, zero, negative, valid, non_integer, lowest, highest, valid_rate); valid is positive."""

    def block(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.struct(
            F.lit(c).alias("column"), F.count("*").alias("rows"), F.count_if(x.isNull()).alias("missing"), F.count_if(x == 0).alias("zero"), F.count_if(x < 0).alias("negative"),
            F.count_if(x > 0).alias("valid"), F.count_if(
                (x > 0) & (F.abs(x - F.rint(x)) > WHOLE)
            ).alias("non_integer"), F.min(F.when(x > 0, x)).alias("lowest"), F.max(F.when(x > 0, x)).alias("highest"),
        )

    got = df.agg(F.array(*[block(c) for c in columns]).alias("b")).select(F.inline("b"))
    return got.withColumn("valid_rate", F.try_divide(F.col("valid").cast("double"), F.col("rows")))


def top_values(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """(column, value, rows, k): the n most frequent values of each column, ties in order of the value; null is <NULL>."""
    flat = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("<NULL>")).alias("value")
                    ) for c in columns
                ]
            )
        )
    )
    counts = flat.groupBy("column", "value").agg(F.count("*").alias("rows"))
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("rows"), "value"))
    return counts.withColumn("k", rank).where(F.col("k") <= n)


def nearest_rank(df: DataFrame, column: str, shares: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Percentiles by nearest rank, from value counts: the least value that enough rows reach."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, F.col(column).alias("v")).agg(F.count("*").alias("n"))
    one = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    run = counts.withColumns({"upto": F.sum("n").over(one.orderBy("v")), "total": F.sum("n").over(one)})
    aggs = [
        F.min(
            F.when(F.col("upto") >= F.greatest(F.lit(1), F.ceil(F.col("total") * F.lit(s))), F.col("v"))
        ).alias(f"p{round(s * 100):02d}") for s in shares
    ]
    return run.groupBy(*keys).agg(
        F.sum("n").alias("valid_rows"), F.min("v").alias("lowest"), *aggs, F.max("v").alias("highest")
    )


def ends(total: Column, share: Column) -> tuple[Column, Column, Column]:
    """Where a share of total rows in order lies, and the rows below and above it, counted from 0."""
    place = (total - 1) * share
    return place, F.floor(place), F.ceil(place)


def around(pieces: DataFrame, group: Sequence[str], start: Column, shares: Sequence[float]) -> DataFrame:
    """Of pieces (group..., piece, n, total) in their order, those in which a share ends; from: the rows below a piece."""
    upto = start + F.sum("n").over(Window.partitionBy(*group).orderBy("piece"))
    rows = [r for s in shares for r in ends(F.col("total"), F.lit(float(s)))[1:]]
    hit = [(r >= F.col("from")) & (r < F.col("from") + F.col("n")) for r in rows]
    return pieces.withColumn("from", upto - F.col("n")).where(reduce(or_, hit)).drop("n")


def percentiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """(column, share, value): exact interpolated percentiles of the positive values, over all rows."""
    flat = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns]))
    )
    return positive_percentiles(flat, shares)


def positive_percentiles(flat: DataFrame, shares: Sequence[float]) -> DataFrame:
    """percentiles() of (column, v), column not being null.

    No task holds the values of a column: rows are counted by magnitude, only pieces in which a share ends are counted by
    value, and these are cut evenly once more before values are put in order.
    """
    flat = flat.where("v > 0").withColumn("piece", F.rint(F.log2("v") * OCTAVE))
    coarse = flat.groupBy("column", "piece").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    coarse = coarse.withColumn("total", F.sum("n").over(Window.partitionBy("column")))
    coarse = around(coarse, ["column"], F.lit(0), shares).withColumnRenamed("from", "before")
    place = ["column", "total", "before"]
    values = flat.join(F.broadcast(coarse), ["column", "piece"]).groupBy(*place, "low", "high", "v").agg(
        F.count("*").alias("n")
    )
    even = F.try_divide(F.col("v") - F.col("low"), F.col("high") - F.col("low"))
    values = values.select(*place, "v", "n", F.coalesce(F.rint(even * EVEN), F.lit(0.0)).alias("piece"))
    fine = values.groupBy(*place, "piece").agg(F.sum("n").alias("n"))
    fine = around(fine, ["column", "before"], F.col("before"), shares).drop("total")
    near = values.join(F.broadcast(fine), ["column", "before", "piece"])
    upto = F.col("from") + F.sum("n").over(Window.partitionBy("column", "from").orderBy("v"))
    near = near.withColumn("upto", upto)

    def at(row: Column) -> Column:
        return F.max(F.when((row >= F.col("upto") - F.col("n")) & (row < F.col("upto")), F.col("v")))

    listed = []
    for s in map(float, shares):
        _, below, above = ends(F.col("total"), F.lit(s))
        listed.append(F.struct(F.lit(s).alias("share"), at(below).alias("low"), at(above).alias("high")))
    got = near.groupBy("column", "total").agg(F.array(*listed).alias("p")).select("column", "total", F.inline("p"))
    exact, below, above = ends(F.col("total"), F.col("share"))
    between = (above - exact) * F.col("low") + (exact - below) * F.col("high")
    return got.select("column", "share", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(between).alias("value"))


def formula_match(
    df: DataFrame, formulas: Mapping[str, tuple[Column, Column, Column]], tolerance: float, keys: Sequence[str] = ()
) -> DataFrame:
    """(keys..., formula, comparable, matched, rate) of formulas {name: (applies, actual, expected)}."""
    rows = df.select(
        *keys,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("formula"), a.alias("applies"), x.cast("double").alias("actual"),
                        y.cast("double").alias("expected")
                    ) for n,
                    (a, x, y) in formulas.items()
                ]
            )
        )
    )
    rows = rows.where(F.col("applies") & F.col("actual").isNotNull() & F.col("expected").isNotNull())
    got = rows.groupBy(*keys, "formula").agg(
        F.count("*").alias("comparable"), F.count_if(close(F.col("actual"), F.col("expected"), tolerance)).alias("matched")
    )
    return got.withColumn("rate", F.try_divide(F.col("matched").cast("double"), F.col("comparable")))


def flag_counts(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """(flag, rows): flags may overlap."""
    got = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()])
    return got.select(F.inline(F.array(*[F.struct(F.lit(n).alias("flag"), F.col(n).alias("rows")) for n in flags])))


def uniqueness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(rows, tuples): a tuple with a null in it counts as a tuple."""
    return df.agg(F.count("*").alias("rows"), F.count_distinct(F.struct(*columns)).alias("tuples"))


def examples(df: DataFrame, keys: Sequence[str], column: str, n: int = 15) -> DataFrame:
    """(keys..., examples): the n least distinct values of each group, kept to n before the exchange ends."""
    distinct = df.where(F.col(column).isNotNull()).select(*keys, column).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(column))
    few = distinct.withColumn("_k", rank).where(F.col("_k") <= n)
    return few.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list(F.col(column).cast("string"))), ",").alias("examples")
    )


def cross_tab(df: DataFrame, a: Column, b: Column) -> DataFrame:
    return df.select(a.alias("a"), b.alias("b")).groupBy("a", "b").agg(F.count("*").alias("rows"))


def relations(df: DataFrame, pairs: Mapping[str, tuple[Column, Column]], slack: float) -> DataFrame:
    """(pair, comparable, satisfied): how often the part is at most the whole, with some slack."""
    rows = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("pair"), p.cast("double").alias("part"), w.cast("double").alias("whole")) for n,
                    (p, w) in pairs.items()
                ]
            )
        )
    )
    rows = rows.where("part is not null and whole is not null")
    return rows.groupBy("pair").agg(
        F.count("*").alias("comparable"), F.count_if(F.col("part") <= F.col("whole") + slack).alias("satisfied")
    )


def detail_total(df: DataFrame, present: Column, detail: Column, total: Column, tolerance: float) -> DataFrame:
    """(present, rows, equal, greater, less) of a detail against its total."""
    gap = detail - total
    return df.groupBy(present.alias("present")).agg(
        F.count("*").alias("rows"), F.count_if(
            F.abs(gap) <= tolerance
        ).alias("equal"), F.count_if(gap > tolerance).alias("greater"), F.count_if(gap < -tolerance).alias("less"),
    )


def distribution(df: DataFrame, key: Column, name: str) -> DataFrame:
    """(name, rows, share) of each value."""
    got = df.groupBy(key.alias(name)).agg(F.count("*").alias("rows"))
    total = got.agg(F.sum("rows").alias("_t"))
    return got.join(F.broadcast(total)).select(name, "rows", (F.col("rows").cast("double") / F.col("_t")).alias("share"))


def transition_report(df: DataFrame, keys: Sequence[str], before: Column, after: Column) -> DataFrame:
    """(keys..., before, after, status): PASS where a regrouping keeps the number of rows."""
    got = df.groupBy(*keys).agg(F.count_if(before).alias("before"), F.count_if(after).alias("after"))
    return got.withColumn("status", F.when(F.col("before") == F.col("after"), "PASS").otherwise("FAIL"))


def unmatched(df: DataFrame, columns: Sequence[str], missed: Column) -> DataFrame:
    """Combinations that found no match, blanks named."""
    return df.where(missed).select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("<BLANK>")).alias(c) for c in columns]
    ).groupBy(*columns).agg(F.count("*").alias("rows"))
