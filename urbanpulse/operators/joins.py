"""Join helpers: salted join for hot keys, hot-key isolation, and the
code -> region crosswalk (J1 / P16).

No join here is chosen by a count: Spark broadcasts a side by its runtime size
(AQE), or keeps a sort-merge join and splits its skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def salted_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                salts: int = 16, salt_from: list[str] | None = None) -> DataFrame:
    """Equi-join where one key of ``big`` may hold a large share of its rows.

    ``big`` rows get a deterministic salt (hash of ``salt_from`` columns, so a
    retried task reproduces it) and ``small`` is replicated once per salt;
    a hot key is then spread over ``salts`` tasks.  Only ``inner``/``left``
    (big side preserved) joins are meaningful here.
    """
    cols = salt_from or big.columns
    b = big.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salts)))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return b.join(s, on + ["_salt"], how).drop("_salt")


def crosswalk(df: DataFrame, region_map: DataFrame, source: str, code_col: str | list[str],
              out: str = "region_code") -> DataFrame:
    """Attach ``region_code`` for (source, code) by a left join; rows whose code
    has no mapping are kept with a null region (see ``unmatched_codes``).

    ``code_col`` may name several columns: their texts joined by ``-`` are the
    code (e.g. district and neighbourhood, as neighbourhood codes repeat)."""
    # one region per code; a duplicated code resolves deterministically
    m = (region_map.where(F.col("source") == F.lit(source))
         .groupBy(F.col("code").alias("_code")).agg(F.min("region_code").alias(out)))
    return df.withColumn("_code", code_text(code_col)).join(m, "_code", "left").drop("_code")


def code_text(code_col: str | list[str]) -> Column:
    """The code of a row, as ``crosswalk`` looks it up."""
    cols = [code_col] if isinstance(code_col, str) else list(code_col)
    return F.concat_ws("-", *[F.col(c).cast("string") for c in cols]) if len(cols) > 1 else F.col(cols[0]).cast("string")


# A key is "hot" when it holds more than this share of the rows.
HOT_SHARE = 1e-4


def unmatched_codes(df: DataFrame, region_map: DataFrame, source: str, code_col: str) -> DataFrame:
    """Codes of ``df`` without a crosswalk entry, with their row counts."""
    m = region_map.where(F.col("source") == F.lit(source)).select(F.col("code").alias("_code"))
    codes = df.groupBy(F.col(code_col).cast("string").alias("code")).count()
    return codes.join(m, F.col("code") == F.col("_code"), "left_anti")


def split_hot_join(big: DataFrame, small: DataFrame, key: str, hot_keys: DataFrame,
                   how: str = "inner") -> DataFrame:
    """Equi-join (``inner``, ``left`` or ``left_semi``; big side preserved) on
    ``key`` with hot keys isolated.

    ``hot_keys`` holds the key values that may carry a large share of
    ``big``'s rows; the caller guarantees it is small (e.g. by a pigeonhole
    bound).  Rows of hot keys meet their ``small`` rows map-side (broadcast);
    the other rows are filtered map-side (broadcast anti-join) *before* the
    shuffle join, so no key in that shuffle is hot.  The two parts are
    disjoint, so their union is exactly ``big JOIN small``."""
    if how not in ("inner", "left", "left_semi"):
        raise ValueError("split_hot_join supports inner, left and left_semi joins")
    hk = F.broadcast(hot_keys.select(key).distinct())
    hot = big.join(hk, key, "left_semi").join(F.broadcast(small.join(hk, key, "left_semi")), key, how)
    cold = big.join(hk, key, "left_anti").join(small, key, how)
    return hot.unionByName(cold)


def apportion(df: DataFrame, shares: DataFrame, code: str, keys: list[str], amount: str,
              out: str = "region_code") -> DataFrame:
    """Amounts of one grain of areas dealt out to another: per ``keys`` and
    region the sum of ``amount`` (whole units, e.g. won), split by ``shares``
    (code, region_code, weight: whole numbers, such as shared square metres) where
    an area overlaps several regions.

    A code's amount goes to its regions by weight, in whole units, the largest
    remainders first (ties by region): the parts of every code, and so the
    whole table, sum to what came in.  Codes without a positive weight keep
    their amount under a null region.  Rows are summed per code before the join,
    so a code that holds most rows costs a row per key."""
    totals = df.groupBy(*keys, F.col(code).alias("_code")).agg(F.sum(F.col(amount).cast("decimal(18,0)")).cast("decimal(18,0)").alias("_sum"))
    w = (shares.filter(F.col("weight") > 0).groupBy(F.col("code").alias("_code"), F.col("region_code").alias(out))
         .agg(F.sum(F.col("weight").cast("decimal(18,0)")).cast("decimal(18,0)").alias("_w")))
    whole = w.groupBy("_code").agg(F.sum("_w").cast("decimal(18,0)").alias("_whole"))
    parts = totals.join(w.join(whole, "_code"), "_code", "left")
    product = F.col("_sum") * F.col("_w")
    rest = F.pmod(product, F.col("_whole").cast("decimal(38,0)"))
    parts = parts.withColumn("_rest", rest).withColumn("_part", F.expr("(_sum * _w - _rest) div _whole"))
    own = Window.partitionBy(*keys, "_code")  # one row per region that the area touches
    left = F.col("_sum") - F.sum("_part").over(own)
    more = F.row_number().over(own.orderBy(F.desc("_rest"), out)) <= left
    share = F.when(F.col("_w").isNull(), F.col("_sum")).otherwise(F.col("_part") + more.cast("int"))
    return (parts.withColumn("_share", share.cast("decimal(38,0)")).groupBy(*keys, out)
            .agg(F.sum("_share").cast("long").alias(amount)))
