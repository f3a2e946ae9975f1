"""Gates of the warehouse and a second computation of its indicators, which shares no code with the one that writes them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage import contract as C
from acreage.operators.merge import recompute_diff

PRICES = ["median_total", "mean_total", "median_unit", "mean_unit"]
VALUES = [*PRICES, "n", *[f"{p}_yoy" for p in PRICES], "n_yoy"]


def snapshot(clean: DataFrame, key: str, rows: int | None = None) -> dict:
    """A batch is one cleaning run's, has each key once and, if rows is given, that many rows; raises where it doesn't."""
    got = clean.agg(
        F.count("*").alias("rows"), F.countDistinct("cleaning_run_id").alias("runs"),
        F.count_if(F.col("cleaning_run_id").isNull()).alias("unnamed")
    ).first()
    if rows is not None and got.rows != rows:
        raise ValueError(f"{got.rows} rows, {rows} expected")
    if got.runs > 1 or got.unnamed:
        raise ValueError(f"the rows of a batch must be of one cleaning run, not of {got.runs}, {got.unnamed} without one")
    repeated = clean.groupBy(key).count().where("count > 1").limit(5).collect()
    if repeated:
        raise ValueError(f"ids repeat within the batch: {[r[0] for r in repeated]}")
    return {"status": "success", "rows": got.rows}


def final_values(source: DataFrame, written: DataFrame, key: str, values: Sequence[str]) -> None:
    """What was written for these keys is what the source says."""
    wrong = recompute_diff(source, written, [key], values).limit(5).collect()
    if wrong:
        raise ValueError(f"facts differ from their source after the write: {[tuple(r) for r in wrong]}")


def first_gap(months: DataFrame, members: DataFrame | None, first: date, last: date) -> DataFrame:
    """The earliest (month, member keys) from first to last that is not among months, or no row."""
    spine = months.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 month"))).alias("month")
    )
    keys = members.columns if members is not None else []
    if members is not None:
        spine = spine.crossJoin(members)
    return spine.join(months.select("month", *keys).distinct(), ["month", *keys], "left_anti").orderBy("month", *keys).limit(1)


def spine(stored: DataFrame, members: DataFrame | None, first: date, last: date, grain: str) -> None:
    """An increment needs a full table before it: every month and member from the fixed start to the published end."""
    gap = first_gap(stored, members, first, last).first()
    if gap is not None:
        raise ValueError(f"{grain} must be rebuilt in full before an increment: {tuple(gap)} is missing")


def grains(tables: Mapping[str, DataFrame]) -> None:
    """Cities add up to the nation, and districts over three months to their city over the same three."""
    national, city, district = tables["national"], tables["city"], tables["district"]
    added = city.groupBy("month").agg(F.sum("n").alias("n"))
    if not unequal(added, national, ["month"]).isEmpty():
        raise ValueError("the cities do not add up to the nation")
    anchors = district.select("month").distinct()
    shifted = city.select(
        "county_id", "n", F.explode(F.array("month", F.add_months("month", 1), F.add_months("month", 2))).alias("month")
    )
    rolled = shifted.groupBy("county_id", "month").agg(F.sum("n").alias("n")).join(anchors, "month", "left_semi")
    if not unequal(district.groupBy("county_id", "month").agg(F.sum("n").alias("n")), rolled, ["county_id", "month"]).isEmpty():
        raise ValueError("the districts do not add up to their cities")


def unequal(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, kind) where the counts n differ or one side has no row."""
    return recompute_diff(a, b, keys, ["n"])


def expected(facts: DataFrame, places: DataFrame, keys: Sequence[str], width: int, start: date, last: date) -> DataFrame:
    """All indicators from the facts, in SQL: a copy of the facts for each month back, ranks of prices for the medians.

    The median is the mean of the middle values by rank, so nothing of the writer's aggregates is used.
    """
    k = "".join(f"{c}, " for c in keys)
    on = lambda a, b: "".join(f" and {a}.{c} = {b}.{c}" for c in keys)
    middle = lambda c: f"avg(case when r_{c} in (floor((m + 1) / 2), ceil((m + 1) / 2)) then {c} end)"
    copies = " union all ".join(
        f"select {k}cast(add_months(month, {b}) as date) as month, total_price, unit_price from placed" for b in range(width)
    )
    change = lambda c: f"cast(try_divide(d.{c}, b.{c}) - 1 as decimal(14,8)) as {c}_yoy"
    members = f"cross join (select distinct {k.rstrip(', ')} from {{places}})" if keys else ""
    return facts.sparkSession.sql(
        f"""
        with placed as (
                 select f.*, {', '.join(f'p.{c}' for c in keys) or '0 as _all'} from {{facts}} f join {{places}} p on f.location_id = p.location_id
                 where transaction_type in ({{house}}, {{parking}}) and total_price is not null and unit_price is not null),
             copies as ({copies}),
             ranked as (
                 select *, row_number() over (partition by {k}month order by total_price) as r_total_price,
                        row_number() over (partition by {k}month order by unit_price) as r_unit_price, count(*) over (partition by {k}month) as m
                 from copies),
             got as (
                 select {k}month, cast({middle('total_price')} / 10000.0D as decimal(18,6)) as median_total, cast(sum(cast(total_price as decimal(20,0))) / count(*) / 10000 as decimal(18,6)) as mean_total,
                        cast({middle('unit_price')} * 3.305785D / 10000.0D as decimal(18,6)) as median_unit, cast(avg(unit_price) * 3.305785D / 10000.0D as decimal(18,6)) as mean_unit, count(*) as n
                 from ranked group by {k}month),
             spine as (select * from (select explode(sequence(date '{start}' + make_ym_interval(0, {width - 1}), date '{last}', interval 1 month)) as month) {members}),
             d as (select s.*, median_total, mean_total, median_unit, mean_unit, coalesce(n, 0) as n from spine s left join got g on s.month = g.month{on('s', 'g')})
        select {''.join(f'd.{c}, ' for c in keys)}d.month, {', '.join(f'd.{c}' for c in PRICES)}, d.n, {', '.join(map(change, PRICES))},
               case when b.n <> 0 then cast(cast(d.n as decimal(18,0)) / cast(b.n as decimal(18,0)) - 1 as decimal(14,8)) end as n_yoy
        from d left join d b on b.month = cast(add_months(d.month, -12) as date){on('d', 'b')}
        """,
        facts=facts, places=places, house=C.HOUSE, parking=C.HOUSE_PARKING,
    )


def first_differences(want: DataFrame, stored: DataFrame, keys: Sequence[str], limit: int = 50) -> DataFrame:
    """A report of the first rows, in order of month and keys, that differ: which side lacks it, else which values differ."""
    a = want.select(*keys, F.struct(*VALUES).alias("e"))
    both = a.join(stored.select(*keys, F.struct(*VALUES).alias("a")), list(keys), "full")
    names = F.array(*[F.when(~F.col(f"e.{v}").eqNullSafe(F.col(f"a.{v}")), F.lit(v)) for v in VALUES])
    found = both.select(
        *keys, F.col("a").isNull().alias("missing"), F.col("e").isNull().alias("unexpected"),
        F.array_join(F.filter(names, lambda x: x.isNotNull()), ",").alias("differing")
    )
    found = found.where("missing or unexpected or differing <> ''")
    return found.select(
        *keys, "missing", "unexpected",
        F.when(~F.col("missing") & ~F.col("unexpected"), F.col("differing")).otherwise("").alias("differing")
    ).orderBy("month", *[c for c in keys if c != "month"]).limit(limit)
