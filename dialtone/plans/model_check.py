"""Model check job: typed load of a model's tables (V1), surrogate keys for
rows loaded without one (V2), and the constraint report (V8).

Constraints are checked after every table is loaded, so the two foreign-key
cycles of the school model (students <-> enrolments, teachers <-> modules)
need no load order, unlike DDL that must add those constraints afterwards.

    python -m dialtone.plans.model_check --base DIR [--out REPORT_DIR] [--assign-keys]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.validate import assign_key, read_model, validate_model
from ..sources.model import SCHOOL_MODEL, TableSpec


def create_tables(spark: SparkSession, base_path: str,
                  model: Sequence[TableSpec] = SCHOOL_MODEL, fmt: str = "parquet") -> list[str]:
    """CREATE TABLE for every table of the model: an empty table with the
    declared schema at ``{base_path}/{name}.{fmt}`` (existing tables are kept,
    like CREATE TABLE IF NOT EXISTS; nothing else is enforced on write)."""
    paths = []
    for spec in model:
        path = f"{base_path}/{spec.name}.{fmt}"
        spark.createDataFrame([], spec.schema).write.mode("ignore").format(fmt).save(path)
        paths.append(path)
    return paths


def load_model(spark: SparkSession, base_path: str, model: Sequence[TableSpec] = SCHOOL_MODEL,
               fmt: str = "parquet", assign_keys: bool = False) -> dict[str, DataFrame]:
    tables = read_model(spark, base_path, model, fmt)
    if assign_keys:
        for spec in model:
            if spec.serial:
                tables[spec.name] = assign_key(tables[spec.name], spec.serial)
    return tables


def check_model(spark: SparkSession, base_path: str, model: Sequence[TableSpec] = SCHOOL_MODEL,
                fmt: str = "parquet", assign_keys: bool = False,
                out_path: str | None = None) -> DataFrame:
    """One row per rule with its violation count; written when ``out_path`` is set."""
    report = validate_model(load_model(spark, base_path, model, fmt, assign_keys), model)
    if out_path:
        report.write.mode("overwrite").parquet(out_path)
        return spark.read.parquet(out_path)
    return report


def main(argv=None) -> None:
    from ..session import build_session, scale_session
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--base", required=True)
    p.add_argument("--out")
    p.add_argument("--format", default="parquet")
    p.add_argument("--assign-keys", action="store_true")
    a = p.parse_args(argv)
    spark = build_session()
    scale_session(spark, [a.base])
    rep = check_model(spark, a.base, fmt=a.format, assign_keys=a.assign_keys, out_path=a.out)
    for row in rep.filter("violations > 0").toLocalIterator():  # a row per rule
        print(*row, sep="\t")


if __name__ == "__main__":
    main()
