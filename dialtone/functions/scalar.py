"""Column expressions. All are built-in Spark functions, so they stay inside
whole-stage code generation; no Python runs per row."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.ivr_schema import LABEL_DEFAULT, LABEL_RULES, SENTINEL

# Fixed value: integer written for a missing integer by the cleaner.
CLEAN_INT_DEFAULT = -99999
DATE_ID_FORMAT = "yyyyMMdd"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_id(c: str | Column) -> Column:
    """Timestamp or date -> 'yyyyMMdd' text (NULL stays NULL)."""
    return F.date_format(_col(c), DATE_ID_FORMAT)


def is_known(c: str | Column, sentinel: str = SENTINEL) -> Column:
    """True when the value is neither NULL nor the sentinel text.

    Same as the three-valued ``c != sentinel`` used as a filter (NULL drops out),
    but never NULL itself, so it is safe inside ``when``/``max``.
    """
    c = _col(c)
    return c.isNotNull() & (c != F.lit(sentinel))


def all_known(cols: Iterable[str | Column], sentinel: str = SENTINEL) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & is_known(c, sentinel)
    return cond


def classify_label(c: str | Column, rules: Sequence[tuple[str, str, str]] = LABEL_RULES,
                   default: str = LABEL_DEFAULT) -> Column:
    """Bucket a label by case-insensitive prefix/exact rules; first match wins.

    A NULL label matches no rule and gets ``default``.
    """
    up = F.upper(_col(c))
    expr = None
    for kind, pattern, cls in rules:
        if kind == "prefix":
            cond = up.startswith(pattern.upper())
        elif kind == "exact":
            cond = up == F.lit(pattern.upper())
        else:
            raise ValueError(f"unknown rule kind {kind!r}")
        expr = F.when(cond, F.lit(cls)) if expr is None else expr.when(cond, F.lit(cls))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def flag(pred: Column) -> Column:
    """1 when the predicate is true, 0 when false or NULL (IF semantics)."""
    return F.when(pred, F.lit(1)).otherwise(F.lit(0))


def whole_hours_between(later: str | Column, earlier: str | Column) -> Column:
    """Whole hours from ``earlier`` to ``later``, truncated toward zero."""
    return F.timestamp_diff("HOUR", _col(earlier), _col(later))


def clean_int(c: str | Column, default: int = CLEAN_INT_DEFAULT) -> Column:
    """NULL integer -> ``default`` (-99999); other values unchanged, as bigint."""
    return F.coalesce(_col(c).cast("bigint"), F.lit(default).cast("bigint"))
