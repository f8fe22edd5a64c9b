"""Cleaning operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import CLEAN_INT_DEFAULT, all_known, clean_int
from ..sources.ivr_schema import SENTINEL


def clean_int_columns(df: DataFrame, cols: Sequence[str],
                      default: int = CLEAN_INT_DEFAULT) -> DataFrame:
    """C1 over chosen columns: NULL -> ``default``; other columns untouched."""
    return df.withColumns({c: clean_int(c, default) for c in cols})


def drop_unknown(df: DataFrame, cols: Sequence[str], sentinel: str = SENTINEL) -> DataFrame:
    """Keep rows where no listed column is NULL or the sentinel text
    (the three-valued ``c != 'UNKNOWN'`` filter). Pushed into the parquet scan
    when the frame is read straight from files."""
    return df.filter(all_known(cols, sentinel))
