"""Constraint checks as Spark jobs over loaded tables (V2-V8).

Violations count the rows a constraint-enforcing database would have rejected:

* NOT NULL     rows with NULL in the column
* PRIMARY KEY  rows with a NULL key, plus every row after the first of a key
* UNIQUE       every row after the first of a key (NULL keys never collide)
* FOREIGN KEY  rows whose non-NULL key has no parent row (NULL passes)
* CHECK        rows whose lower-cased value is outside the allowed list (NULL passes)
* VARCHAR(n)   rows whose text is longer than n characters (NULL passes)

Row-level rules of a table (NOT NULL, CHECK, VARCHAR) are evaluated in ONE
aggregate over one scan. Key rules are ``groupBy(key).count()`` (combined
map-side, so a hot key costs one row per task). Foreign keys compare distinct
keys with distinct keys. The whole-model report reads every table once and
has one aggregate for all keys of all rules.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.model import TableSpec
from .sequence import row_sequence

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
_TEXT = (T.StringType, T.CharType, T.VarcharType)
_NARROW = (*_INTEGRAL, *_FLOATING, T.DateType, T.BooleanType)


def _any_null(cols: Sequence[str]) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(Column.__and__, conditions)


# --- predicates ----------------------------------------------------------------------
def domain_violation(col: str, allowed: Sequence[str]) -> Column:
    """True when the value is set and its lower case is not allowed."""
    c = F.col(col)
    return c.isNotNull() & ~F.lower(c).isin([a.lower() for a in allowed])


def length_violation(col: str, max_len: int) -> Column:
    return F.char_length(F.col(col)) > F.lit(max_len)


# --- V3 / V6 / V7: row-level rules --------------------------------------------------
def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """V3: (column_name, violations) for each column, in one aggregate."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return agg.unpivot([], list(cols), "column_name", "violations")


def check_domain(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """V6: the rows that break CHECK (lower(col) IN allowed)."""
    return df.filter(domain_violation(col, allowed))


def check_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """V7: (column_name, max_length, violations) per column, in one aggregate."""
    aggs = []
    for c, n in limits.items():
        aggs.append(F.count_if(length_violation(c, n)).alias(c))
    counts = df.agg(*aggs).unpivot([], list(limits), "column_name", "violations")
    lim = F.create_map(*sum([[F.lit(c), F.lit(n)] for c, n in limits.items()], []))
    return counts.select("column_name", lim[F.col("column_name")].alias("max_length"),
                         "violations")


# --- V4: keys --------------------------------------------------------------------------
def check_unique(df: DataFrame, cols: Sequence[str], allow_null: bool = True, by_hash: bool | None = None,
                 digest: Callable[..., Column] = F.xxhash64) -> DataFrame:
    """V4: keys held by more than one row, with their row count ``n``.

    With ``allow_null`` (UNIQUE) keys with a NULL part are ignored; without it
    (PRIMARY KEY) they are reported as one group whose ``n`` counts NULL rows.

    ``by_hash`` counts 64-bit hashes of the keys first; only rows whose hash repeats bring their
    keys to the exact step, so keys that are wide move 8 bytes a row. By default wide keys
    (several columns, texts) go that way. Keys that share a hash meet in the exact step.
    """
    cols = list(cols)
    if by_hash is None:
        by_hash = len(cols) > 1 or not isinstance(df.schema[cols[0]].dataType, _NARROW)
    rows = df.select(*cols)
    if allow_null:
        rows = rows.where(~_any_null(cols))
    if by_hash:
        # hashes compare as the keys do: -0.0 hashes like 0.0
        plain = [F.when(F.col(c) == 0, F.lit(0).cast(df.schema[c].dataType)).otherwise(F.col(c))
                 if isinstance(df.schema[c].dataType, _FLOATING) else F.col(c) for c in cols]
        hashed = rows.withColumn("_h", digest(*plain))
        whole = hashed if allow_null else hashed.where(~_any_null(cols))
        again = whole.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("_h").alias("_again"))
        kept = whole.join(again, F.col("_h") == F.col("_again"), "left_semi").select(*cols)
        rows = kept if allow_null else kept.unionByName(rows.where(_any_null(cols)))
    groups = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return groups.filter(F.col("n") > 1) if allow_null else groups.filter(_any_null(cols) | (F.col("n") > 1))


# --- V5: foreign keys -----------------------------------------------------------------
def check_foreign_key(child: DataFrame, fk: Sequence[str], parent: DataFrame,
                      pk: Sequence[str]) -> DataFrame:
    """V5: child rows whose (non-NULL) key has no parent row.

    The orphan keys are found among the child's distinct keys (combined map-side);
    only rows that hold one are joined back, so a hot key is one row in the anti join.
    """
    fk, pk = list(fk), list(pk)
    known = parent.select(*[F.col(p).alias(f"_pk{i}") for i, p in enumerate(pk)]).distinct()
    used = child.filter(~_any_null(fk)).select(*[F.col(c).alias(f"_fk{i}") for i, c in enumerate(fk)]).distinct()
    orphans = used.join(known, _all(used[f"_fk{i}"] == known[f"_pk{i}"] for i in range(len(fk))), "left_anti")
    return child.join(orphans, _all(child[c] == orphans[f"_fk{i}"] for i, c in enumerate(fk)), "left_semi")


# --- V2: surrogate keys ---------------------------------------------------------------
def assign_key(df: DataFrame, key: str, order_by: Sequence[str] = (), start: int | None = None) -> DataFrame:
    """V2: give rows with a NULL ``key`` new keys, increasing in ``order_by``.

    New keys are ``start + 1, start + 2, ...``; ``start`` defaults to the
    current maximum key (0 for none), so new keys never collide with existing
    ones. The numbering is distributed (a sort by ranges plus a prefix sum
    over per-partition counts); no global window, nothing collected. Without ``order_by``
    keys are unique and above the maximum, in no order, and no range sort is made.
    """
    if key not in df.columns:
        df = df.withColumn(key, F.lit(None).cast("bigint"))
    kt = df.schema[key].dataType
    have = df.filter(F.col(key).isNotNull())
    todo = df.filter(F.col(key).isNull()).drop(key)
    if start is None:
        start_col = F.coalesce(have.agg(F.max(key)).scalar(), F.lit(0)).cast("bigint")
    else:
        start_col = F.lit(start).cast("bigint")
    numbered = row_sequence(todo, list(order_by), name=key, start=start_col)
    numbered = numbered.withColumn(key, F.col(key).cast(kt))
    return have.unionByName(numbered.select(*df.columns))


# --- V8: whole-model report -----------------------------------------------------------
MASK_BITS = 60  # row rules that one number tells of


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type in which keys of two types compare equal as SQL compares them; None if they don't compare."""
    if isinstance(a, _TEXT) and isinstance(b, _TEXT):
        return T.StringType()
    if isinstance(a, _INTEGRAL) and isinstance(b, _INTEGRAL):
        return T.LongType()
    numeric = (*_INTEGRAL, *_FLOATING, T.DecimalType)
    if isinstance(a, numeric) and isinstance(b, numeric):
        if isinstance(a, _FLOATING) or isinstance(b, _FLOATING):
            return T.DoubleType()
        scale = max(getattr(t, "scale", 0) for t in (a, b))
        return T.DecimalType(38, min(scale, 18))
    if isinstance(a, T.DateType) and isinstance(b, (T.TimestampType, T.TimestampNTZType)):
        return b
    if isinstance(b, T.DateType) and isinstance(a, (T.TimestampType, T.TimestampNTZType)):
        return a
    return a if a == b else None


@dataclass(frozen=True)
class _Entry:
    """What a row says to one key rule: its key in the rule's types, as a holder or as a parent."""
    rule: int
    columns: Sequence[str]
    types: Sequence[T.DataType]
    when: Column
    parent: bool = False

    def slots(self) -> list[tuple[int, str]]:
        return [(i, t.simpleString()) for i, t in enumerate(self.types)]


def validate_model(tables: Mapping[str, DataFrame], model: Sequence[TableSpec]) -> DataFrame:
    """V8: one row per rule of the model with its violation count.

    Every table is read once. A row tells each key rule its key, in columns of the key's own type (a
    parent tells the rules that refer to it), and the row rules that it breaks as one number
    with a bit per rule, if it breaks any. One aggregate by (rule, key), combined map-side,
    counts holders and parents of every key of every rule; a second one adds up each rule. There is no
    join, so neither a hot key nor a foreign-key cycle (students <-> enrolments, teachers <->
    modules) needs care. Keys compare as SQL compares their types: 0.0 is -0.0, NaN is NaN. A
    reference whose types don't compare (text to a number) has NULL violations.
    """
    names: list[tuple[str, str, str]] = []
    kinds: list[str] = []
    keyed: dict[str, list[_Entry]] = {}
    masks: list[tuple[str, list[tuple[int, Column]]]] = []  # (table, up to MASK_BITS row rules)
    unknown: list[int] = []

    def rule(table: str, kind: str, columns: str) -> int:
        names.append((table, kind, columns))
        kinds.append(kind)
        return len(names) - 1

    for spec in model:
        df, entries = tables[spec.name], keyed.setdefault(spec.name, [])
        own = lambda cols, df=df: [common_type(df.schema[c].dataType, df.schema[c].dataType) for c in cols]
        if spec.primary_key:
            cols = spec.primary_key
            entries.append(_Entry(rule(spec.name, "primary_key", ",".join(cols)), cols, own(cols), F.lit(True)))
        for cols in spec.unique:
            entries.append(_Entry(rule(spec.name, "unique", ",".join(cols)), cols, own(cols), ~_any_null(cols)))
        for fk in spec.foreign_keys:
            i = rule(spec.name, "foreign_key", f"{','.join(fk.columns)}->{fk.parent}({','.join(fk.parent_columns)})")
            types = [common_type(df.schema[c].dataType, tables[fk.parent].schema[p].dataType)
                     for c, p in zip(fk.columns, fk.parent_columns, strict=True)]
            if None in types:
                unknown.append(i)
                continue
            entries.append(_Entry(i, fk.columns, types, ~_any_null(fk.columns)))
            keyed.setdefault(fk.parent, []).append(
                _Entry(i, fk.parent_columns, types, ~_any_null(fk.parent_columns), parent=True))
        rows = [(rule(spec.name, "not_null", c), F.col(c).isNull()) for c in dict.fromkeys(spec.not_null)]
        rows += [(rule(spec.name, "check", d.column), domain_violation(d.column, d.allowed)) for d in spec.domains]
        rows += [(rule(spec.name, "max_length", f"{c}({n})"), length_violation(c, n)) for c, n in spec.max_lengths.items()]
        masks += [(spec.name, rows[at:at + MASK_BITS]) for at in range(0, len(rows), MASK_BITS)]

    slots = sorted({s for entries in keyed.values() for e in entries for s in e.slots()})
    null = F.lit(None)
    long = lambda x: F.lit(x).cast("bigint")

    def said(e: _Entry) -> list[Column]:
        mine = dict(zip(e.slots(), zip(e.columns, e.types, strict=True), strict=True))
        key = [F.col(mine[s][0]).cast(mine[s][1]) if s in mine else null.cast(s[1]) for s in slots]
        return [F.when(e.when, F.lit(e.rule)), null.cast("bigint"), _any_null(e.columns), long(0 if e.parent else 1),
                long(1 if e.parent else 0), *key]

    def broken(number: int, rules: list[tuple[int, Column]]) -> list[Column]:
        bits = reduce(Column.__add__, [F.when(c, long(1 << b)).otherwise(long(0)) for b, (_, c) in enumerate(rules)])
        return [F.when(bits != 0, F.lit(-1 - number)), bits, F.lit(False), long(1), long(0), *[null.cast(s[1]) for s in slots]]

    columns = ["rule", "mask", "null_key", "n", "parents", *[f"k{i}" for i in range(len(slots))]]
    told = []
    for table in dict.fromkeys([*keyed, *(t for t, _ in masks)]):
        lines = [said(e) for e in keyed.get(table, ())] + [broken(i, r) for i, (t, r) in enumerate(masks) if t == table]
        if lines:
            told.append(tables[table].select(F.stack(F.lit(len(lines)), *[c for line in lines for c in line]).alias(*columns))
                        .where("rule IS NOT NULL"))
    spark = tables[model[0].name].sparkSession
    every = spark.range(len(names)).select(F.col("id").cast("int").alias("rule"), F.lit(0).cast("bigint").alias("violations"))
    label = [F.array(*map(F.lit, column))[F.col("rule")] for column in zip(*names, strict=True)]
    counts = every
    if told:
        keys = (reduce(DataFrame.unionByName, told).groupBy("rule", "mask", "null_key", *columns[5:])
                .agg(F.sum("n").alias("n"), F.sum("parents").alias("parents")))
        kind = F.get(F.array(*map(F.lit, kinds)), F.col("rule"))
        count = (F.when(F.col("rule") < 0, F.col("n"))
                 .when(kind == "foreign_key", F.when(F.col("parents") == 0, F.col("n")).otherwise(0))
                 .when(F.col("null_key"), F.col("n")).otherwise(F.col("n") - 1))
        # a row per key rule, and one per combination of row rules that some row breaks
        sums = keys.groupBy("rule", "mask").agg(F.sum(count).cast("bigint").alias("violations"))
        by_bit = F.lit(None).cast("array<int>")
        for number, (_, rules) in enumerate(masks):
            own = F.array(*[F.when(F.col("mask").bitwiseAND(long(1 << b)) != 0, F.lit(i)) for b, (i, _) in enumerate(rules)])
            by_bit = F.when(F.col("rule") == -1 - number, F.array_compact(own)).otherwise(by_bit)
        rules = F.when(F.col("rule") < 0, by_bit).otherwise(F.array("rule"))
        counts = every.unionByName(sums.select(F.explode(rules).alias("rule"), "violations"))
    total = F.sum("violations")
    if unknown:
        total = F.when(~F.col("rule").isin(unknown), total)
    return (counts.groupBy("rule").agg(total.alias("violations"))
            .select(label[0].alias("table_name"), label[1].alias("rule"), label[2].alias("columns"), "violations"))


def read_model(spark: SparkSession, base_path: str, model: Sequence[TableSpec],
               fmt: str = "parquet") -> dict[str, DataFrame]:
    """V1: typed reads of every table of the model (``{base_path}/{name}.{fmt}``)."""
    from ..sources.tables import read_typed
    out = {}
    for spec in model:
        path = f"{base_path}/{spec.name}.{fmt}"
        if spec.schema is not None:
            out[spec.name] = read_typed(spark, path, spec.schema, fmt)
        else:
            out[spec.name] = spark.read.format(fmt).load(path)
    return out
