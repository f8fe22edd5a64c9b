"""End-to-end IVR jobs: base tables -> detail table -> summary tables.

Each step replaces its output table (``CREATE OR REPLACE TABLE ... AS`` in the
source) by a new version of it (``sources.versions``). Writing the detail once and reading it back cuts the lineage between
the two jobs: a lost executor re-runs at most the current job's stages, and
the summary reads the detail columnar-pruned from files instead of
re-running the three-level join.

The detail is partitioned by ``calls_start_date_id`` (one folder per day), so
time-bounded reads prune partitions.

    python -m dialtone.plans.ivr_jobs --calls P --modules P --steps P --out DIR
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from ..operators.detail import build_detail, prefixed_calls
from ..operators.summary import build_summary
from ..sources.ivr_schema import (
    CALLS_SCHEMA, DETAIL_COLUMNS, DETAIL_SCHEMA, MODULES_SCHEMA, STEPS_SCHEMA,
)
from ..sources.tables import read_typed
from ..sources.versions import load_table, save_table

DETAIL_PARTITION = "calls_start_date_id"


def detail_job(spark: SparkSession, calls: DataFrame, modules: DataFrame, steps: DataFrame,
               out_path: str) -> DataFrame:
    """Build and replace the detail table; return it read back from files."""
    det = build_detail(calls, modules, steps)
    save_table(det, out_path, [DETAIL_PARTITION])
    return read_detail(spark, out_path)


def read_detail(spark: SparkSession, path: str) -> DataFrame:
    """The detail table with its declared schema (partition values would
    otherwise be inferred as integers)."""
    return load_table(spark, path, DETAIL_SCHEMA).select(*DETAIL_COLUMNS)


def save_by_phone(calls: DataFrame, table: str, buckets: int) -> DataFrame:
    """Call rows (prefixed) as a catalog table bucketed and sorted by phone, start and call id: the
    repeat flags of this table need no exchange. Replaces the table."""
    cols = ["calls_phone_number", "calls_start_date", "calls_ivr_id"]
    (calls.repartition(buckets, cols[0]).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, cols[0]).sortBy(*cols).saveAsTable(table))
    return calls.sparkSession.table(table)


def summary_job(spark: SparkSession, detail: DataFrame, out_path: str, method: str = "max",
                calls: DataFrame | None = None) -> str:
    """Build and replace a summary table (S3 with method='max', S4 with 'best_row')."""
    summ = build_summary(detail, method=method,
                         calls=prefixed_calls(calls) if calls is not None else None)
    return save_table(summ, out_path)


def run(spark: SparkSession, calls_path: str, modules_path: str, steps_path: str,
        out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """Detail, then both summaries, from typed base tables."""
    calls = read_typed(spark, calls_path, CALLS_SCHEMA, fmt)
    modules = read_typed(spark, modules_path, MODULES_SCHEMA, fmt)
    steps = read_typed(spark, steps_path, STEPS_SCHEMA, fmt)
    paths = {"ivr_detail": os.path.join(out_dir, "ivr_detail"),
             "ivr_summary": os.path.join(out_dir, "ivr_summary"),
             "ivr_summary_second_method": os.path.join(out_dir, "ivr_summary_second_method")}
    det = detail_job(spark, calls, modules, steps, paths["ivr_detail"])
    summary_job(spark, det, paths["ivr_summary"], "max")
    summary_job(spark, det, paths["ivr_summary_second_method"], "best_row")
    return paths


def main(argv=None) -> None:
    from ..session import build_session, scale_session
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--calls", required=True)
    p.add_argument("--modules", required=True)
    p.add_argument("--steps", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--format", default="parquet")
    a = p.parse_args(argv)
    spark = build_session()
    scale_session(spark, [a.calls, a.modules, a.steps])
    for name, path in run(spark, a.calls, a.modules, a.steps, a.out, a.format).items():
        print(name, path)


if __name__ == "__main__":
    main()
