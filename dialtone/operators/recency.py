"""Repeat-call flags (F9): for every distinct (call, phone, start) the previous and
next start of the same phone, and whether each is less than 24 whole hours away.

Rows are ordered by (start, call id): the call id breaks ties between equal
start times so the result is deterministic. NULL phones and the 'UNKNOWN'
phone are windows like any other, as in the source.

* Phones with a usual number of calls take one window per phone. Where the input is a table bucketed
  by phone (``plans.ivr_jobs.save_by_phone``), neither the distinct rows nor the window needs
  an exchange.
* Phones that hold more than one task should have (in practice the 'UNKNOWN' or NULL
  phone), found with a frequent-items sketch, are range-partitioned and sorted in
  (phone, start, call id) order; the sampled bounds split them. ``lag``/``lead`` run per range
  partition, and the first / last row of a partition takes its neighbour from a
  one-row-per-partition table (bounded, broadcast). A neighbour counts when it has the
  same phone. Exact for any distribution, including a burst of equal start times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import flag, whole_hours_between
from ..sources.ivr_schema import OUT
from .joins import Skew

KEY, ENTITY, TS = "calls_ivr_id", "calls_phone_number", "calls_start_date"


def _flags(prev: Column, nxt: Column, ts: str, hours: int,
           rep_name: str, cause_name: str) -> list[Column]:
    return [
        flag(prev.isNotNull() & (whole_hours_between(F.col(ts), prev) < hours)).alias(rep_name),
        flag(nxt.isNotNull() & (whole_hours_between(nxt, F.col(ts)) < hours)).alias(cause_name),
    ]


def hot_entities(df: DataFrame, entity: str, skew: Skew) -> list:
    """The values of ``entity`` (None among them) that hold too many rows for one task."""
    found = df.agg(F.expr(f"approx_top_k({entity}, {skew.most}, {skew.tracked})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = max(skew.least_rows, skew.factor * found["n"] / parts)
    return [r["item"] for r in found["top"] if r["count"] >= least]


def recency_flags(df: DataFrame, key: str = KEY, entity: str = ENTITY, ts: str = TS,
                  hours: int = 24, skew: Skew | None = Skew(),
                  rep_name: str = OUT["repeated"],
                  cause_name: str = OUT["recall"], ordered: bool = False) -> DataFrame:
    """Columns: key, entity, ts, previous_call, next_call, <rep_name>, <cause_name>.

    ``skew`` looks for hot phones before planning (one aggregate over the phone column); None
    gives every phone a window. ``ordered=True`` adds the source's final ORDER BY (call id,
    phone) as a range-partitioned global sort.
    """
    hot = hot_entities(df, entity, skew) if skew else []
    base = df.select(key, entity, ts)
    out = None
    if hot:
        known = [v for v in hot if v is not None]
        is_hot = F.coalesce(F.col(entity).isin(known), F.lit(False)) if known else F.lit(False)
        if None in hot:
            is_hot = is_hot | F.col(entity).isNull()
        out = _positional_neighbours(base.where(is_hot).distinct(), key, entity, ts)
        base = base.where(~is_hot)
    w = Window.partitionBy(entity).orderBy(F.col(ts).asc_nulls_first(), F.col(key).asc_nulls_first())
    usual = base.distinct().select(key, entity, ts, F.lag(ts).over(w).alias("previous_call"), F.lead(ts).over(w).alias("next_call"))
    out = usual if out is None else usual.unionByName(out)
    out = out.select(key, entity, ts, "previous_call", "next_call",
                     *_flags(F.col("previous_call"), F.col("next_call"), ts, hours,
                             rep_name, cause_name))
    return out.orderBy(key, entity) if ordered else out


def _positional_neighbours(base: DataFrame, key: str, entity: str, ts: str) -> DataFrame:
    """Neighbours in (phone, start, call id) order without a window per phone.

    Rows are range-partitioned and sorted on that order
    (``sequence.sorted_partitions``); the sampled bounds split any hot phone
    over many partitions. ``lag``/``lead`` then run per range partition (each
    one a bounded, balanced slice). Only a partition's first and last rows
    need a neighbour from elsewhere: the last row of the previous non-empty
    partition and the first row of the next one, read from a table with one
    row per partition (bounded by the partition count, so it is broadcast).
    A neighbour counts only when it belongs to the same phone.
    """
    from .sequence import partitions
    r = base.select(key, entity, ts, F.col(entity).isNull().alias("_en"),
                    F.coalesce(F.col(entity).cast("string"), F.lit("")).alias("_ev"))
    loose, s = partitions(r, ["_en", "_ev", ts, key])
    row = F.struct("_en", "_ev", F.col(ts).alias("t"))
    w = Window.partitionBy("_pid").orderBy("_pos")
    inside = s.select(key, entity, ts, "_en", "_ev", "_pid",
                      F.lag(row).over(w).alias("_p"), F.lead(row).over(w).alias("_n"))
    # the smallest and largest row need no sort; all columns take part, so that both
    # branches read the same exchange
    whole = F.struct("_en", "_ev", F.col(ts).alias("t"), F.col(key).alias("k"), F.col(entity).alias("e"))
    ends = loose.groupBy("_pid").agg(F.min(whole).alias("_first"), F.max(whole).alias("_last"))
    cut = lambda c: F.struct(F.col(c)["_en"].alias("_en"), F.col(c)["_ev"].alias("_ev"), F.col(c)["t"].alias("t"))
    by_pid = Window.orderBy("_pid")
    edges = ends.select("_pid", F.lag(cut("_last")).over(by_pid).alias("_pl"),
                        F.lead(cut("_first")).over(by_pid).alias("_nf"))
    j = inside.join(F.broadcast(edges), "_pid")
    prev = F.coalesce(F.col("_p"), F.col("_pl"))
    nxt = F.coalesce(F.col("_n"), F.col("_nf"))

    def same_phone(c):
        return (c["_en"] == F.col("_en")) & (c["_ev"] == F.col("_ev"))

    return j.select(key, entity, ts,
                    F.when(same_phone(prev), prev["t"]).alias("previous_call"),
                    F.when(same_phone(nxt), nxt["t"]).alias("next_call"))
