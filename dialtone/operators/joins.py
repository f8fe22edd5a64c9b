"""Left joins that stand hot keys.

In a left outer join adaptive execution may split only the left side, so a key that
holds a third of the right side's rows stays in one task. ``hot_keys`` finds such keys
with a frequent-items sketch, one narrow aggregate over the key columns; the sketch
holds a fixed number of items, so what comes back is bounded. ``left_join`` then salts
those keys only: their right rows are dealt over ``salts`` numbers and their left rows
are repeated once per number. All others, and all where no key is hot, take the plain
left join. A hot key has right rows, so the copies of its left rows that met
none are dropped afterwards and the result is the plain join's.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Skew:
    """When a key is hot: it holds ``least_rows`` rows and ``factor`` mean shuffle partitions at least."""
    least_rows: int = 1_000_000
    factor: float = 4.0
    rows_per_salt: int = 500_000
    tracked: int = 10_000       # items in the sketch
    most: int = 200             # keys that are salted; a factor of 4 leaves a quarter of the partitions' number at most


@dataclass(frozen=True)
class HotKeys:
    keys: list[tuple]
    salts: int


def hot_keys(df: DataFrame, keys: Sequence[str], skew: Skew = Skew()) -> HotKeys | None:
    """The hot keys of ``df``, None if there is none. Rows with a NULL key can't match and don't count."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    rows = df.where(known).select(*[F.col(k) for k in keys])
    one = len(keys) == 1
    item = rows.select((F.col(keys[0]) if one else F.xxhash64(*keys)).alias("k"))
    found = item.agg(F.expr(f"approx_top_k(k, {skew.most}, {skew.tracked})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = max(skew.least_rows, skew.factor * found["n"] / parts)
    hot = [(r["item"], r["count"]) for r in found["top"] if r["count"] >= least]
    if not hot:
        return None
    salts = min(parts, max(2, -(-max(n for _, n in hot) // skew.rows_per_salt)))
    if one:
        return HotKeys([(k,) for k, _ in hot], salts)
    # the sketch knows hashes; the keys behind them are as few
    marked = rows.where(F.xxhash64(*keys).isin([k for k, _ in hot])).distinct().collect()
    return HotKeys([tuple(r) for r in marked], salts)


def _is_hot(keys: Sequence[str], hot: HotKeys) -> Column:
    one = lambda values: F.struct(*[F.lit(v).alias(f"k{i}") for i, v in enumerate(values)])
    mine = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return known & mine.isin(*[one(v) for v in hot.keys])


def _cond(left: DataFrame, right: DataFrame, lk: Sequence[str], rk: Sequence[str]):
    cond = None
    for a, b in zip(lk, rk, strict=True):
        c = left[a] == right[b]
        cond = c if cond is None else cond & c
    return cond


def left_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
              right_keys: Sequence[str], hot: HotKeys | None = None) -> DataFrame:
    """LEFT OUTER JOIN on ``left_keys == right_keys``; output = left cols + right cols.

    Column names of the two sides must not collide. ``hot``: keys of the right side to salt.
    """
    out_cols = left.columns + right.columns
    if hot is None:
        return left.join(right, _cond(left, right, left_keys, right_keys), "left").select(*out_cols)
    # equal rows spread over the input partitions they come from
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in right.columns]), F.lit(hot.salts)).cast("int")
    right = right.withColumn("_rsalt", F.when(_is_hot(right_keys, hot), salt).otherwise(0))
    every = F.sequence(F.lit(0), F.lit(hot.salts - 1))
    left = (left.withColumn("_hot", _is_hot(left_keys, hot))
            .withColumn("_lsalt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))))
    joined = left.join(right, _cond(left, right, [*left_keys, "_lsalt"], [*right_keys, "_rsalt"]), "left")
    return joined.where(~(F.col("_hot") & F.col(right_keys[0]).isNull())).select(*out_cols)
