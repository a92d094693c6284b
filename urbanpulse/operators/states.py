"""Mergeable partial states of the indicators (A3-A7), stored per set and year,
so that a daily run touches the years that changed (G3).

A state is a sum and a count per region, period and measure.  Values are summed
as whole multiples of 1 / SCALE: the order of the rows, and whether a year was
computed today or a month ago, make no difference to a sum.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.sinks import write_parquet

SCALE = 1_000_000
STATE = ["source", "YEAR", "region_code", "period", "measure", "total", "n"]


def _per_area(amount: Column, area: str) -> Column:
    return amount / F.nullif(F.col(area), F.lit(0.0))


#: Measures of each processed set: name -> value of a row (null rows don't count).
MEASURES = {
    "real_estate": {"price": lambda rate: _per_area(F.col("THING_AMT"), "ARCH_AREA")},
    "rent": {"rent": lambda rate: _per_area(F.col("RTFE") + F.col("GRFE") * F.lit(rate / 12.0), "RENT_AREA")},
    "sales": {"sales": lambda rate: F.col("THSMON_SELNG_AMT")},
    "population_ages": {c: (lambda rate, c=c: F.col(c)) for c in ("young", "old", "TOT_LVPOP_CO")},
}


def partial_states(df: DataFrame, source: str, rate: float = 0.05) -> DataFrame:
    """``STATE`` rows of a set with YEAR, region_code and period; rows without a
    region or period don't take part.  One aggregate over one scan."""
    sums = []
    for name, value in MEASURES[source].items():
        whole = F.round(value(rate) * SCALE).cast("decimal(20,0)")
        sums += [F.sum(whole).alias(f"{name}_s"), F.count(whole).alias(f"{name}_n")]
    wide = df.filter(F.col("region_code").isNotNull() & F.col("period").isNotNull()).groupBy("YEAR", "region_code", "period").agg(*sums)
    states = F.inline(F.array(*[F.struct(F.lit(n).alias("measure"), F.col(f"{n}_s").cast("decimal(30,0)").alias("total"),
                                         F.col(f"{n}_n").alias("n")) for n in MEASURES[source]]))
    return wide.select(F.lit(source).alias("source"), "YEAR", "region_code", "period", states).select(*STATE)


def refresh_states(spark: SparkSession, path: str, sets: dict[str, DataFrame], years: list[int] | None = None,
                   rate: float = 0.05) -> None:
    """Compute the states of ``sets`` anew and replace those stored at ``path``:
    of all years, or of the given ``years`` only; partitions of other years are
    neither read nor written.  The sets are read with a filter on their
    partition column YEAR.  A year that no longer has rows leaves its states: drop
    its partition with the year's data."""
    parts = [partial_states(df if years is None else df.filter(F.col("YEAR").isin(years)), name, rate) for name, df in sets.items()]
    write_parquet(reduce(DataFrame.unionByName, parts), path, partition_by=["source", "YEAR"])


def merged(states: DataFrame) -> DataFrame:
    """One row per region and period: the indicators before W3 (price, rent,
    sales, youth_share, senior_share), from states of any number of parts."""
    own = lambda m, c: F.sum(F.when(F.col("measure") == m, F.col(c)))
    mean = lambda m: own(m, "total").cast("double") / F.nullif(own(m, "n"), F.lit(0)) / SCALE
    total = F.nullif(own("TOT_LVPOP_CO", "total").cast("double") / own("TOT_LVPOP_CO", "n"), F.lit(0.0))
    share = lambda m: own(m, "total").cast("double") / own(m, "n") / total
    return states.groupBy("region_code", "period").agg(
        mean("price").alias("price"), mean("rent").alias("rent"), (own("sales", "total").cast("double") / SCALE).alias("sales"),
        share("young").alias("youth_share"), share("old").alias("senior_share"))
