from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from dialtone.operators import validate
from dialtone.sources.model import SCHOOL_MODEL, SCHOOL_TABLES, ForeignKey, TableSpec


def _school(spark):
    """The nine tables with planted violations (see expected counts below)."""
    t = {}

    def mk(name, data):
        t[name] = spark.createDataFrame(data, SCHOOL_TABLES[name].schema, verifySchema=False)

    mk("adresses", [(1, "calle", "Mayor", 3, None, "A", "28001", "Madrid", "ES"),
                    (2, "avda", "Sol", None, None, "B" * 11, "28002", "Madrid", "ES")])  # letter > 10
    mk("administratives", [
        (1, "Ana", "Ruiz", "ES", "600", "ana@x", 1, None, None, date(2023, 1, 1), None, "Temporal", None),
        (2, None, "Gil", "ES", "6" * 21, "ana@x", 9, None, None, date(2023, 1, 1), None, "freelance", None),
        (2, "Bea", "Sanz", "ES", None, None, None, None, None, None, None, None, None)])
    mk("students", [(1, "Sol", "Paz", None, None, "s1@x", 1, 10),
                    (2, "Lu", "Rey", None, None, "s2@x", None, 99),          # enrolment 99 missing
                    (3, "Mar", "Rio", None, None, None, 2, None)])
    mk("bootcamps", [(1, "Data", 3, None, None, 10, 30, Decimal("9.5"), Decimal("400.25"),
                      Decimal("80"), 8)])
    mk("editions", [(1, 1, 1, None, None, Decimal("6500.00"), 20),
                    (2, 5, 1, None, None, Decimal("6500.00"), 20)])            # bootcamp 5 missing
    mk("enrolments", [(10, 1, 1, 1, Decimal("6000.50"), "card", None, None, True),
                      (11, 7, 1, 3, None, None, None, None, None)])            # student 7, edition 3
    mk("teachers", [(1, "Eva", "Sol", None, None, "e@x", 1, 1, date(2022, 1, 1), None, None, None),
                    (2, "Rui", "Paz", None, None, "e@x", None, 4, date(2022, 1, 1), None, None, None)])
    mk("modules", [(1, "SQL", "Transversal", None, None, True, 10, Decimal("20.5"), 1, 1),
                   (2, "ML", "advanced", None, None, False, 3, None, 3, None),  # bad type, teacher 3
                   (None, "Py", "separate_course", None, None, None, None, None, None, None)])
    mk("marks", [(1, "apto", None, 1, 1, 10), (2, "7.5", "8", 3, 2, 12)])   # enrolment 12 missing
    return t


def test_school_model_report(spark):
    report = {(r.table_name, r.rule, r.columns): r.violations
              for r in validate.validate_model(_school(spark), SCHOOL_MODEL).collect()}
    nonzero = {k: v for k, v in report.items() if v}
    assert nonzero == {
        ("adresses", "max_length", "letter(10)"): 1,
        ("administratives", "primary_key", "administrative_id"): 1,
        ("administratives", "unique", "email"): 1,
        ("administratives", "not_null", "name"): 1,
        ("administratives", "not_null", "email"): 1,
        ("administratives", "not_null", "start_contract"): 1,
        ("administratives", "check", "type_contract"): 1,
        ("administratives", "max_length", "telephone(20)"): 1,
        ("administratives", "foreign_key", "adress_id->adresses(adress_id)"): 1,
        ("students", "not_null", "email"): 1,
        ("students", "foreign_key", "enrolment_id->enrolments(enrolment_id)"): 1,
        ("teachers", "unique", "email"): 1,
        ("teachers", "foreign_key", "module_id->modules(module_id)"): 1,
        ("editions", "foreign_key", "bootcamp_id->bootcamps(bootcamp_id)"): 1,
        ("enrolments", "foreign_key", "student_id->students(student_id)"): 1,
        ("enrolments", "foreign_key", "edition_id->editions(edition_id)"): 1,
        ("modules", "primary_key", "module_id"): 1,
        ("modules", "check", "type_module"): 1,
        ("modules", "foreign_key", "teacher_id->teachers(teacher_id)"): 1,
        ("marks", "foreign_key", "enrolment_id->enrolments(enrolment_id)"): 1,
    }
    # every declared rule has a row: 9 PK + 3 UNIQUE + 14 FK + 16 NOT NULL + 2 CHECK + lengths
    n_len = sum(len(t.max_lengths) for t in SCHOOL_MODEL)
    assert len(report) == 9 + 3 + 14 + 16 + 2 + n_len


def test_unique_vs_primary_key_nulls(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (1,), (2,)], "k int")
    assert sorted(validate.check_unique(df, ["k"]).collect()) == [(1, 2)]
    pk = sorted(validate.check_unique(df, ["k"], allow_null=False).collect(), key=str)
    assert pk == [(1, 2), (None, 2)]


def test_foreign_key_null_passes(spark):
    child = spark.createDataFrame([(1,), (None,), (3,)], "fk int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "pk int")
    assert [r.fk for r in validate.check_foreign_key(child, ["fk"], parent, ["pk"]).collect()] == [3]


def test_not_null_domain_length(spark):
    df = spark.createDataFrame([("Temporal", "abc"), (None, "abcdef"), ("otro", None)], "t string, s string")
    assert dict(validate.check_not_null(df, ["t", "s"]).collect()) == {"t": 1, "s": 1}
    assert [r.t for r in validate.check_domain(df, "t", ["temporal"]).collect()] == ["otro"]
    assert [tuple(r) for r in validate.check_length(df, {"s": 3}).collect()] == [("s", 3, 1)]


def test_typed_read_keeps_decimals(spark, tmp_path):
    t = _school(spark)
    path = str(tmp_path)
    t["bootcamps"].write.parquet(f"{path}/bootcamps.parquet")
    back = validate.read_model(spark, path, [SCHOOL_TABLES["bootcamps"]])["bootcamps"]
    assert back.first().duration_hours == Decimal("400.2500")


def test_report_reads_each_table_once_without_joins(spark, tmp_path):
    for name, df in _school(spark).items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    plan = validate.validate_model(validate.read_model(spark, str(tmp_path), SCHOOL_MODEL), SCHOOL_MODEL)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == len(SCHOOL_MODEL)
    assert "Join" not in text


def test_report_of_empty_tables_has_every_rule(spark):
    empty = {t.name: spark.createDataFrame([], t.schema) for t in SCHOOL_MODEL}
    report = validate.validate_model(empty, SCHOOL_MODEL).collect()
    assert len(report) > 30 and not any(r.violations for r in report)


def test_composite_and_mixed_width_keys(spark):
    spec = TableSpec("child", primary_key=("a", "b"), unique=(("a",),), foreign_keys=(ForeignKey(("a", "b"), "parent", ("x", "y")),))
    child = spark.createDataFrame([(1, "u"), (1, "u"), (1, None), (None, "v"), (2, "v"), (3, "w")], "a int, b string")
    parent = spark.createDataFrame([(1, "u"), (3, None), (3, "x")], "x bigint, y string")
    got = {r.rule: r.violations for r in validate.validate_model({"child": child, "parent": parent}, [spec]).collect()}
    assert got == {"primary_key": 3, "unique": 2, "foreign_key": 2}
    rows = validate.check_foreign_key(child, ["a", "b"], parent, ["x", "y"]).collect()
    assert sorted((r.a, r.b) for r in rows) == [(2, "v"), (3, "w")]


def test_report_compares_keys_as_their_types_do(spark):
    nan = float("nan")
    spec = [TableSpec("child", unique=(("d",),), foreign_keys=(ForeignKey(("d",), "parent", ("p",)), ForeignKey(("i",), "parent", ("p",)),
                                                              ForeignKey(("n",), "parent", ("m",)), ForeignKey(("t",), "parent", ("p",)))),
            TableSpec("parent", primary_key=("p",))]
    child = spark.createDataFrame([(-0.0, 0, Decimal("2.50"), "0"), (0.0, 7, Decimal("3.00"), "x"), (nan, 2, None, None), (nan, None, Decimal("9.10"), "2")],
                                  "d double, i int, n decimal(9,2), t string")
    parent = spark.createDataFrame([(0.0, Decimal("2.5")), (nan, Decimal("3.0")), (2.0, None)], "p double, m decimal(5,1)")
    got = {(r.rule, r.columns): r.violations for r in validate.validate_model({"child": child, "parent": parent}, spec).collect()}
    assert got == {("unique", "d"): 2,                       # 0.0 and -0.0, NaN and NaN
                   ("foreign_key", "d->parent(p)"): 0, ("foreign_key", "i->parent(p)"): 1,
                   ("foreign_key", "n->parent(m)"): 1,       # 9.10
                   ("foreign_key", "t->parent(p)"): None,    # text against a number doesn't compare
                   ("primary_key", "p"): 0}


def test_more_row_rules_than_one_mask(spark):
    n = validate.MASK_BITS + 15
    cols = [f"c{i}" for i in range(n)]
    df = spark.createDataFrame([tuple(None if i % 7 == 0 else "ab" for i in range(n)), tuple("abc" for _ in range(n))],
                               ", ".join(f"{c} string" for c in cols))
    spec = TableSpec("wide", not_null=tuple(cols), max_lengths={c: 2 for c in cols})
    got = {(r.rule, r.columns): r.violations for r in validate.validate_model({"wide": df}, [spec]).collect()}
    assert len(got) == 2 * n
    for i, c in enumerate(cols):
        assert got["not_null", c] == (i % 7 == 0) and got["max_length", f"{c}(2)"] == 1


def test_unique_by_hash_stays_exact(spark):
    data = [(i % 40, f"k{i % 60}", float(i % 2) * -0.0) for i in range(300)] + [(None, "a", 1.0), (None, "a", 1.0), (1, None, None)]
    df = spark.createDataFrame(data, "a int, b string, c double")
    few = lambda *cols: F.pmod(F.xxhash64(*cols), F.lit(7))  # noqa: E731  many keys share a hash
    for allow_null in (True, False):
        plain = sorted(map(str, validate.check_unique(df, ["a", "b", "c"], allow_null, by_hash=False).collect()))
        assert plain
        assert sorted(map(str, validate.check_unique(df, ["a", "b", "c"], allow_null, by_hash=True).collect())) == plain
        assert sorted(map(str, validate.check_unique(df, ["a", "b", "c"], allow_null, by_hash=True, digest=few).collect())) == plain
