import os

import pytest

from dialtone.operators.detail import build_detail
from dialtone.operators.summary import build_summary
from dialtone.plans import ivr_jobs, model_check
from dialtone.sources import versions
from dialtone.sources.model import SCHOOL_MODEL

from conftest import rows
from fixtures import ivr_frames
from test_validate import _school


def test_ivr_jobs_replace_tables(spark, tmp_path):
    calls, mods, steps = ivr_frames(spark)
    base = str(tmp_path)
    for name, df in (("calls", calls), ("modules", mods), ("steps", steps)):
        df.write.parquet(os.path.join(base, name))
    out = os.path.join(base, "out")
    for _ in range(2):   # running twice replaces, never appends
        paths = ivr_jobs.run(spark, *(os.path.join(base, n) for n in ("calls", "modules", "steps")), out)
    det = ivr_jobs.read_detail(spark, paths["ivr_detail"])
    direct = build_detail(calls, mods, steps)
    assert rows(det.select(*direct.columns)) == rows(direct)
    s1 = versions.load_table(spark, paths["ivr_summary"])
    s2 = versions.load_table(spark, paths["ivr_summary_second_method"])
    assert rows(s1) == rows(build_summary(direct, "max"))
    assert s2.count() == s1.count()


def test_model_check_with_key_assignment(spark, tmp_path):
    tables = _school(spark)
    base = str(tmp_path)
    for name, df in tables.items():
        df.write.parquet(os.path.join(base, f"{name}.parquet"))
    rep = {(r.table_name, r.rule, r.columns): r.violations
           for r in model_check.check_model(spark, base, SCHOOL_MODEL, assign_keys=True).collect()}
    # modules had a row without key: it gets a fresh one, so the PK holds
    assert rep[("modules", "primary_key", "module_id")] == 0
    # administratives has a duplicated id (not NULL): still reported
    assert rep[("administratives", "primary_key", "administrative_id")] == 1


def test_create_tables_then_check_is_clean(spark, tmp_path):
    base = str(tmp_path)
    paths = model_check.create_tables(spark, base, SCHOOL_MODEL)
    assert len(paths) == 9
    back = spark.read.parquet(paths[-1])
    assert back.count() == 0 and [f.name for f in back.schema.fields][0] == "mark_id"
    rep = model_check.check_model(spark, base, SCHOOL_MODEL).collect()
    assert rep and all(r.violations == 0 for r in rep)


def _ids(spark, path):
    return sorted(r.id for r in versions.load_table(spark, path).collect())


def test_failed_write_keeps_the_old_table(spark, tmp_path):
    path = os.path.join(str(tmp_path), "t")
    versions.save_table(spark.range(3), path)
    broken = spark.range(5).selectExpr("if(id = 4, raise_error('no'), id) AS id").selectExpr("cast(id AS bigint) AS id")
    with pytest.raises(Exception):
        versions.save_table(broken, path)
    assert _ids(spark, path) == [0, 1, 2]
    versions.save_table(versions.load_table(spark, path).where("id > 0"), path)   # a table may be made from itself
    assert _ids(spark, path) == [1, 2]
    versions.save_table(spark.range(9, 10), path)
    assert len([f for f in os.listdir(path) if f.startswith("v-")]) == 2   # the current version and the one before


@pytest.mark.parametrize("step", ["write_version", "point", "drop_versions"])
@pytest.mark.parametrize("after", [False, True])
def test_a_stop_between_any_two_steps_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, step, after):
    path = os.path.join(str(tmp_path), "t")
    versions.save_table(spark.range(3), path)
    versions.save_table(spark.range(2), path)
    real = getattr(versions, step)

    def stopped(*args, **options):
        if after:
            real(*args, **options)
        raise KeyboardInterrupt

    monkeypatch.setattr(versions, step, stopped)
    with pytest.raises(KeyboardInterrupt):
        versions.save_table(spark.range(10, 14), path)
    monkeypatch.undo()
    new = (step, after) in {("point", True), ("drop_versions", False), ("drop_versions", True)}
    assert _ids(spark, path) == (list(range(10, 14)) if new else [0, 1])
    versions.save_table(spark.range(5), path)   # and the next replacement clears what was left
    assert _ids(spark, path) == list(range(5))
    assert len([f for f in os.listdir(path) if f.startswith("v-")]) == 2


@pytest.mark.parametrize("step", ["write_version", "drop_versions"])
def test_catalog_table_moves_its_location(spark, tmp_path, monkeypatch, step):
    path = os.path.join(str(tmp_path), "t")
    spark.sql("DROP TABLE IF EXISTS moved")
    versions.save_catalog_table(spark.range(3), "moved", path)
    first = versions.current_location(spark, "moved")
    real = getattr(versions, step)

    def stopped(*args, **options):
        real(*args, **options)
        raise KeyboardInterrupt

    monkeypatch.setattr(versions, step, stopped)
    with pytest.raises(KeyboardInterrupt):
        versions.save_catalog_table(spark.table("moved").where("id > 0"), "moved", path)
    monkeypatch.undo()
    assert sorted(r.id for r in spark.table("moved").collect()) == ([0, 1, 2] if step == "write_version" else [1, 2])
    versions.save_catalog_table(spark.range(7), "moved", path)
    assert spark.table("moved").count() == 7 and versions.current_location(spark, "moved") != first
    with pytest.raises(ValueError):
        versions.save_catalog_table(spark.range(7).selectExpr("id AS other"), "moved", path)
    spark.sql("DROP TABLE moved")


def test_a_day_has_few_files(spark, tmp_path):
    path = os.path.join(str(tmp_path), "t")
    days = spark.range(0, 4000, 1, 8).selectExpr("id", "cast(id % 5 AS string) AS day")
    versions.save_table(days, path, ["day"])
    assert versions.load_table(spark, path).count() == 4000
    name, _ = versions.current_version(spark, path)
    for day in range(5):
        files = [f for f in os.listdir(os.path.join(path, name, f"day={day}")) if f.endswith(".parquet")]
        assert len(files) == 1
