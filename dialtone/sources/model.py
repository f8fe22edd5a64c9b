"""Declared relational models: schemas plus the constraints a loader must check.

A Spark parquet table does not enforce PRIMARY KEY, UNIQUE, FOREIGN KEY or
CHECK and accepts NULL into a NOT NULL column, so the constraints are data
here and ``operators.validate`` checks them as jobs over loaded tables.

``SCHOOL_MODEL`` is the nine-table training-school model; ``TPCH_MODEL`` states
the same kinds of rules for the driver's TPC-H-like tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Domain:
    column: str
    allowed: tuple[str, ...]      # compared lower-cased; NULL passes


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType | None = None
    primary_key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    domains: tuple[Domain, ...] = ()
    max_lengths: dict[str, int] = field(default_factory=dict)
    serial: str | None = None      # surrogate key column assigned on load


# Types used by the school model. Bare DECIMAL would be decimal(10,0) in Spark
# and drop fractions, so precision is explicit.
_MONEY = T.DecimalType(18, 2)
_QTY = T.DecimalType(18, 4)


def _s(n: int):
    return ("string", n)


def _spec(name: str, cols: list[tuple[str, object]], pk: str, not_null=(), unique=(),
          fks=(), domains=()) -> TableSpec:
    # Every field stays nullable: NOT NULL lives in the rule list, since Spark
    # would trust a non-nullable field and fail on the very NULLs to report.
    fields, lengths = [], {}
    for col, typ in cols:
        if isinstance(typ, tuple):
            fields.append(T.StructField(col, T.StringType(), True))
            lengths[col] = typ[1]
        else:
            fields.append(T.StructField(col, typ, True))
    return TableSpec(
        name=name, schema=T.StructType(fields), primary_key=(pk,), not_null=tuple(not_null),
        unique=tuple((u,) for u in unique),
        foreign_keys=tuple(ForeignKey((c,), p, (pc,)) for c, p, pc in fks),
        domains=tuple(Domain(c, tuple(v)) for c, v in domains),
        max_lengths=lengths, serial=pk)


I, D, B = T.IntegerType(), T.DateType(), T.BooleanType()

# --- fixed values: the nine-table school model (names, types, limits, rules) ------
SCHOOL_MODEL: list[TableSpec] = [
    _spec("adresses", [
        ("adress_id", I), ("type_road", _s(255)), ("name_road", _s(450)), ("number_floor", I),
        ("staircase", _s(255)), ("letter", _s(10)), ("zip_code", _s(20)), ("city", _s(255)),
        ("country", _s(255))], "adress_id"),
    _spec("administratives", [
        ("administrative_id", I), ("name", _s(255)), ("surname", _s(255)),
        ("nationality", _s(255)), ("telephone", _s(20)), ("email", _s(255)), ("adress_id", I),
        ("rol", _s(500)), ("sector", _s(500)), ("start_contract", D), ("end_contract", D),
        ("type_contract", _s(255)), ("end_reason", _s(500))], "administrative_id",
        not_null=("name", "surname", "email", "start_contract"), unique=("email",),
        fks=[("adress_id", "adresses", "adress_id")],
        domains=[("type_contract", ("temporal", "indefinido", "practicas", "externo"))]),
    _spec("students", [
        ("student_id", I), ("name", _s(255)), ("surname", _s(255)), ("nationality", _s(255)),
        ("telephone", _s(20)), ("email", _s(255)), ("adress_id", I), ("enrolment_id", I)],
        "student_id", not_null=("name", "surname", "email"), unique=("email",),
        fks=[("adress_id", "adresses", "adress_id"),
             ("enrolment_id", "enrolments", "enrolment_id")]),
    _spec("teachers", [
        ("teacher_id", I), ("name", _s(255)), ("surname", _s(255)), ("nationality", _s(255)),
        ("telephone", _s(20)), ("email", _s(255)), ("adress_id", I), ("module_id", I),
        ("start_contract", D), ("end_contract", D), ("type_contract", _s(255)),
        ("end_reason", _s(500))], "teacher_id",
        not_null=("name", "surname", "email", "start_contract"), unique=("email",),
        fks=[("adress_id", "adresses", "adress_id"), ("module_id", "modules", "module_id")]),
    _spec("bootcamps", [
        ("bootcamp_id", I), ("name", _s(255)), ("number_editions", I),
        ("first_edition_date", D), ("last_edition_date", D), ("min_number_students", I),
        ("max_number_students", I), ("duration_months", _QTY), ("duration_hours", _QTY),
        ("number_lessons", _QTY), ("number_modules", I)], "bootcamp_id",
        not_null=("name", "min_number_students", "duration_hours", "number_modules")),
    _spec("editions", [
        ("edition_id", I), ("bootcamp_id", I), ("number_edition", I), ("start_date", D),
        ("end_date", D), ("price_edition", _MONEY), ("total_amount_students", I)], "edition_id",
        not_null=("price_edition",), fks=[("bootcamp_id", "bootcamps", "bootcamp_id")]),
    _spec("enrolments", [
        ("enrolment_id", I), ("student_id", I), ("bootcamp_id", I), ("edition_id", I),
        ("price_payed", _MONEY), ("type_payment", _s(255)), ("type_discount", _s(255)),
        ("amount_discount", _MONEY), ("has_passed", B)], "enrolment_id",
        fks=[("student_id", "students", "student_id"),
             ("bootcamp_id", "bootcamps", "bootcamp_id"),
             ("edition_id", "editions", "edition_id")]),
    _spec("modules", [
        ("module_id", I), ("name", _s(255)), ("type_module", _s(100)), ("creation_date", D),
        ("elimination_date", D), ("is_recorded", B), ("number_classes_or_videos", I),
        ("duration_hours", _QTY), ("teacher_id", I), ("bootcamp_id", I)], "module_id",
        fks=[("teacher_id", "teachers", "teacher_id"),
             ("bootcamp_id", "bootcamps", "bootcamp_id")],
        domains=[("type_module", ("transversal", "specialised", "separate_course"))]),
    _spec("marks", [
        ("mark_id", I), ("note", _s(100)), ("second_try_note", _s(100)), ("student_id", I),
        ("module_id", I), ("enrolment_id", I)], "mark_id",
        fks=[("student_id", "students", "student_id"), ("module_id", "modules", "module_id"),
             ("enrolment_id", "enrolments", "enrolment_id")]),
]

SCHOOL_TABLES = {t.name: t for t in SCHOOL_MODEL}


def _fk(cols, parent, pcols) -> ForeignKey:
    return ForeignKey(tuple(cols), parent, tuple(pcols))


ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType())])

# Rules over the driver's tables (read with their own parquet schema where none is declared).
TPCH_MODEL: list[TableSpec] = [
    TableSpec("region", primary_key=("r_regionkey",), not_null=("r_name",),
              max_lengths={"r_name": 25}),
    TableSpec("nation", primary_key=("n_nationkey",), not_null=("n_name", "n_regionkey"),
              foreign_keys=(_fk(["n_regionkey"], "region", ["r_regionkey"]),),
              max_lengths={"n_name": 25}),
    TableSpec("customer", primary_key=("c_custkey",), not_null=("c_name", "c_nationkey"),
              foreign_keys=(_fk(["c_nationkey"], "nation", ["n_nationkey"]),),
              domains=(Domain("c_mktsegment", ("automobile", "building", "furniture",
                                               "household", "machinery")),),
              max_lengths={"c_name": 25, "c_mktsegment": 10}),
    TableSpec("supplier", primary_key=("s_suppkey",), not_null=("s_name", "s_nationkey"),
              foreign_keys=(_fk(["s_nationkey"], "nation", ["n_nationkey"]),),
              max_lengths={"s_name": 25}),
    TableSpec("part", primary_key=("p_partkey",), not_null=("p_name",),
              max_lengths={"p_name": 55, "p_brand": 10, "p_type": 25}),
    TableSpec("orders", schema=ORDERS_SCHEMA, primary_key=("o_orderkey",), not_null=("o_custkey", "o_orderdate"),
              foreign_keys=(_fk(["o_custkey"], "customer", ["c_custkey"]),),
              domains=(Domain("o_orderstatus", ("f", "o", "p")),),
              max_lengths={"o_orderpriority": 15}),
    TableSpec("lineitem", not_null=("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
              unique=(("l_orderkey", "l_linenumber"),),
              foreign_keys=(_fk(["l_orderkey"], "orders", ["o_orderkey"]),
                            _fk(["l_partkey"], "part", ["p_partkey"]),
                            _fk(["l_suppkey"], "supplier", ["s_suppkey"])),
              domains=(Domain("l_returnflag", ("a", "n", "r")),
                       Domain("l_linestatus", ("f", "o"))),
              max_lengths={"l_returnflag": 1, "l_linestatus": 1}),
    TableSpec("events", primary_key=("event_id",), not_null=("ts", "user_id", "event_type"),
              domains=(Domain("event_type", ("click", "view", "purchase", "signup")),),
              max_lengths={"event_type": 8}),
]
