"""DuckDB oracle SQL for every registered query.

Each statement runs on the driver's parquet tables (registered as views) and
re-derives the IVR tables with the same bindings as ``dialtone.sources.bindings``,
written independently in DuckDB's dialect.

Dialect notes: DuckDB's ``date_diff('hour', ...)`` counts hour boundaries, so
whole elapsed hours use ``date_sub``; SUM over BIGINT widens to HUGEINT, so sums
are cast back; arrays are compared as text (``array_to_string``).
"""

from __future__ import annotations

CALLS = """calls AS (
  SELECT CAST(event_id AS DOUBLE) AS ivr_id,
         CASE WHEN user_id % 25 = 0 THEN 'UNKNOWN' ELSE CAST(user_id AS VARCHAR) END AS phone_number,
         event_type AS ivr_result,
         CASE event_type WHEN 'click' THEN 'atc_web' WHEN 'error' THEN 'TECH_L2'
              WHEN 'view' THEN 'absorption' WHEN 'purchase' THEN NULL ELSE event_type END AS vdn_label,
         ts AS start_date,
         ts + to_minutes(CAST(floor(value) AS BIGINT)) AS end_date,
         CAST(floor(value * 60) AS BIGINT) AS total_duration,
         CASE WHEN user_id % 3 = 0 THEN 'RESIDENTIAL' WHEN user_id % 3 = 1 THEN 'SMALL_BUSINESS'
              ELSE 'CORPORATE' END AS customer_segment,
         CASE WHEN user_id % 5 = 0 THEN 'ENGLISH' ELSE 'SPANISH' END AS ivr_language,
         CAST(event_id % 7 AS INTEGER) AS steps_module,
         upper(event_type) AS module_aggregation
  FROM events)"""

MODS = """mods AS (
  SELECT CAST(l_orderkey AS DOUBLE) AS ivr_id, l_linenumber AS module_sequece,
         CASE WHEN l_returnflag = 'R' THEN 'AVERIA_MASIVA' ELSE 'OTHER' END AS module_name,
         CAST(l_linenumber * 30 AS BIGINT) AS module_duration,
         CASE WHEN l_returnflag = 'N' THEN 'OK' ELSE 'KO' END AS module_result
  FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem) x
  UNION ALL SELECT DISTINCT CAST(o_custkey AS DOUBLE), 0, 'HEADER', 0, 'OK' FROM orders)"""

STEPS = """steps AS (
  SELECT CAST(l_orderkey AS DOUBLE) AS ivr_id, l_linenumber AS module_sequece,
         CAST(l_partkey % 10 AS INTEGER) AS step_sequence,
         CASE l_returnflag WHEN 'A' THEN 'CUSTOMERINFOBYPHONE.TX' WHEN 'N' THEN 'CUSTOMERINFOBYDNI.TX'
              ELSE 'X' END AS step_name,
         CASE WHEN l_tax > CAST(0.04 AS DOUBLE) THEN 'OK' ELSE 'KO' END AS step_result,
         CASE WHEN l_tax > CAST(0.04 AS DOUBLE) THEN NULL ELSE 'ERROR' END AS step_description_error,
         CASE WHEN l_suppkey % 3 = 0 THEN 'UNKNOWN' ELSE 'DNI' END AS document_type,
         CASE WHEN l_partkey % 3 = 0 THEN 'UNKNOWN' ELSE CAST(l_partkey AS VARCHAR) END AS document_identification,
         CASE WHEN l_suppkey % 10 <> 0 THEN 'UNKNOWN' ELSE CAST(l_suppkey AS VARCHAR) END AS customer_phone,
         CASE WHEN l_partkey % 4 <> 0 THEN 'UNKNOWN' ELSE CAST(l_partkey AS VARCHAR) END AS billing_account_id
  FROM lineitem)"""

DET = """det AS (
  SELECT calls.ivr_id AS calls_ivr_id,
         calls.phone_number AS calls_phone_number,
         calls.ivr_result AS calls_ivr_result,
         calls.vdn_label AS calls_vdn_label,
         calls.start_date AS calls_start_date,
         strftime(calls.start_date, '%Y%m%d') AS calls_start_date_id,
         calls.end_date AS calls_end_date,
         strftime(calls.end_date, '%Y%m%d') AS calls_end_date_id,
         calls.total_duration AS calls_total_duration,
         calls.customer_segment AS calls_customer_segment,
         calls.ivr_language AS calls_ivr_language,
         calls.steps_module AS calls_steps_module,
         calls.module_aggregation AS calls_module_aggregation,
         m.module_sequece AS module_sequece,
         m.module_name AS module_name,
         m.module_duration AS module_duration,
         m.module_result AS module_result,
         s.step_sequence AS step_sequence,
         s.step_name AS step_name,
         s.step_result AS step_result,
         s.step_description_error AS step_description_error,
         s.document_type AS document_type,
         s.document_identification AS document_identification,
         s.customer_phone AS customer_phone,
         s.billing_account_id AS billing_account_id
  FROM calls
  LEFT JOIN mods m ON calls.ivr_id = m.ivr_id
  LEFT JOIN steps s ON m.ivr_id = s.ivr_id AND m.module_sequece = s.module_sequece)"""

IVR_CTES = "WITH " + ",\n".join([CALLS, MODS, STEPS, DET])


def ivr(sql: str, extra_ctes: str = "") -> str:
    """Prefix a query over ``det`` / ``calls`` / ``mods`` / ``steps`` with the bindings."""
    head = IVR_CTES + (",\n" + extra_ctes if extra_ctes else "")
    return head + "\n" + sql


# --- features of a call ---------------------------------------------------------------
# One grouped table holds all of a call's features; sorted distinct lists come straight
# from the aggregate, so ranks are list positions and counts are list lengths.
BASE_COLS = ["calls_phone_number", "calls_ivr_result", "calls_start_date", "calls_end_date",
             "calls_total_duration", "calls_customer_segment", "calls_ivr_language",
             "calls_steps_module", "calls_module_aggregation"]
BEST_PAYLOAD = BASE_COLS + ["customer_phone", "billing_account_id"]

FACTS = """facts AS (
  SELECT calls_ivr_id,
    list_sort(list(DISTINCT {'t': document_type, 'n': document_identification})
      FILTER (document_type <> 'UNKNOWN' AND document_identification <> 'UNKNOWN')) AS docs,
    list_sort(list(DISTINCT billing_account_id) FILTER (billing_account_id <> 'UNKNOWN')) AS bills,
    list_sort(list(DISTINCT customer_phone) FILTER (customer_phone <> 'UNKNOWN')) AS phones,
    coalesce(bool_or(module_name = 'AVERIA_MASIVA'), false)::INT AS outage,
    coalesce(bool_or(step_name = 'CUSTOMERINFOBYPHONE.TX' AND step_result = 'OK'), false)::INT AS by_phone,
    coalesce(bool_or(step_name = 'CUSTOMERINFOBYPHONE.TX' AND step_result = 'OK'
      AND customer_phone <> 'UNKNOWN'), false)::INT AS by_known_phone,
    coalesce(bool_or(step_name = 'CUSTOMERINFOBYDNI.TX' AND step_result = 'OK'), false)::INT AS by_dni
  FROM det GROUP BY calls_ivr_id)"""

# label classes as a table of patterns; what none matches is 'RESTO'
LABELS = """label_patterns(pattern, class) AS (
  VALUES ('^ATC', 'FRONT'), ('^TECH', 'TECH'), ('^ABSORPTION$', 'ABSORPTION')),
labelled AS (
  SELECT c.ivr_id AS calls_ivr_id, c.vdn_label AS calls_vdn_label, coalesce(p.class, 'RESTO') AS vdn_aggregation
  FROM (SELECT DISTINCT ivr_id, vdn_label FROM calls) c
  LEFT JOIN label_patterns p ON regexp_matches(upper(c.vdn_label), p.pattern))"""

# the calls of a phone in time order as one list: neighbours are the next places
TIMELINES = """timelines AS (
  SELECT phone_number, list_sort(list(DISTINCT {'began': start_date, 'id': ivr_id}), 'ASC', 'NULLS FIRST') AS line
  FROM calls GROUP BY phone_number),
neighbours AS (
  SELECT phone_number, line[i].id AS id, line[i].began AS began,
         CASE WHEN i > 1 THEN line[i - 1].began END AS previous_call,
         CASE WHEN i < len(line) THEN line[i + 1].began END AS next_call
  FROM (SELECT phone_number, line, unnest(range(1, len(line) + 1)) AS i FROM timelines)),
repeats AS (
  SELECT id AS calls_ivr_id, phone_number AS calls_phone_number, began AS calls_start_date, previous_call, next_call,
         coalesce(began - previous_call < INTERVAL 24 HOUR, false)::INT AS "repeated_phone_24H",
         coalesce(next_call - began < INTERVAL 24 HOUR, false)::INT AS "cause_recall_phone_24H"
  FROM neighbours)"""

MAX_BASE = ("base AS (SELECT ivr_id AS calls_ivr_id, "
            + ", ".join(f"max({c[6:]}) AS {c}" for c in BASE_COLS) + " FROM calls GROUP BY ivr_id)")
KNOWN = " + ".join(f"coalesce({c} <> 'UNKNOWN', false)::INT"
                   for c in ("calls_phone_number", "customer_phone", "billing_account_id"))
FIRST = ", ".join([f"{KNOWN} DESC", *(f"{c} DESC NULLS LAST" for c in BEST_PAYLOAD)])
BEST_BASE = ("base AS (SELECT calls_ivr_id, "
             + ", ".join(f"picked.{c} AS {c}" for c in BEST_PAYLOAD)
             + " FROM (SELECT calls_ivr_id, first({"
             + ", ".join(f"'{c}': {c}" for c in BEST_PAYLOAD)
             + f"}} ORDER BY {FIRST}) AS picked FROM det GROUP BY calls_ivr_id))")


def summary(base: str) -> str:
    """A row per label class, known phone and repeat variant of a call."""
    own = ", ".join(f"b.{c} AS {c[6:]}" for c in BASE_COLS)
    return ivr(f"""
SELECT b.calls_ivr_id AS ivr_id, {own}, l.vdn_aggregation,
  array_to_string(list_transform(f.docs, lambda x: x.t), ',') AS document_type,
  array_to_string(list_transform(f.docs, lambda x: x.n), ',') AS document_identification,
  unnest(coalesce(f.phones, [NULL])) AS customer_phone, array_to_string(f.bills, ',') AS billing_account_id,
  f.outage AS masiva_lg, f.by_known_phone AS info_by_phone_lg, f.by_dni AS info_by_dni_lg,
  r."repeated_phone_24H", r."cause_recall_phone_24H" AS "cause_recall_24H"
FROM base b LEFT JOIN facts f USING (calls_ivr_id) LEFT JOIN labelled l USING (calls_ivr_id)
LEFT JOIN repeats r USING (calls_ivr_id)""", ",\n".join([base, FACTS, LABELS, TIMELINES]))


def per_call(columns: str, where: str = "true") -> str:
    return ivr(f"SELECT calls_ivr_id, {columns} FROM facts WHERE {where}", FACTS)


CLEAN_INT = ivr("SELECT calls_ivr_id, " + ", ".join(
    f"coalesce({c}, -99999)::BIGINT AS {c}" for c in ("module_sequece", "step_sequence", "calls_steps_module")) + " FROM det")
PLACES = "SELECT *, unnest(range(1, len(docs) + 1)) AS place FROM facts WHERE len(docs) > 1"

IVR_ORACLES = {
    "ivr_detail": ivr("SELECT * FROM det"),
    "date_id": ivr("""SELECT ivr_id, strftime(start_date, '%Y%m%d') AS start_date_id,
                             strftime(end_date, '%Y%m%d') AS end_date_id FROM calls"""),
    "classify_label": ivr("SELECT * FROM labelled", LABELS),
    "flag_module": per_call("outage AS masiva_lg"),
    "flag_step": per_call("by_phone AS info_by_phone_lg"),
    "flag_step_sum": per_call("by_dni AS info_by_dni_lg"),
    "flag_step_refined": per_call("by_known_phone AS info_by_phone_lg"),
    "call_flags": per_call("outage AS masiva_lg, by_known_phone AS info_by_phone_lg, by_dni AS info_by_dni_lg"),
    "key_cardinality": ivr("""SELECT sum(n)::BIGINT AS total_registros, count(*) AS total_registros_unicos
FROM (SELECT calls_ivr_id, count(*) AS n FROM det WHERE calls_ivr_id IS NOT NULL GROUP BY 1)"""),
    "value_combinations": ivr("""SELECT calls_ivr_id, document_type, document_identification, count(*) AS number_repeticiones
FROM det WHERE 'UNKNOWN' NOT IN (document_type, document_identification) GROUP BY ALL"""),
    "combination_coverage": ivr("""SELECT count(*) AS num_unique_calls, sum(len(docs))::BIGINT AS total_combinations
FROM facts WHERE len(docs) > 0""", FACTS),
    "values_per_key_histogram": ivr("""SELECT n AS num_docs, count(*) AS number_calls
FROM (SELECT len(list_distinct(list_transform(docs, lambda x: x.t || '-' || x.n))) AS n FROM facts WHERE len(docs) > 0) GROUP BY n""", FACTS),
    "ranked_values": ivr(f"""SELECT calls_ivr_id, docs[place].t AS document_type, docs[place].n AS document_identification,
  place::INT AS rn, len(docs) AS docs_per_call FROM ({PLACES})""", FACTS),
    "ranked_accounts": ivr("""SELECT calls_ivr_id, bills[place] AS billing_account_id, place::INT AS rn, len(bills) AS bills_per_call
FROM (SELECT *, unnest(range(1, len(bills) + 1)) AS place FROM facts)""", FACTS),
    "distinct_per_group": per_call("unnest(phones) AS customer_phone, 1::BIGINT AS phones_per_register"),
    "multi_valued_keys": per_call("len(bills) AS bills_per_register", "len(bills) > 1"),
    "multi_valued_phones": per_call("len(phones) AS phones_per_register", "len(phones) > 1"),
    "collect_structs": per_call("""len(docs) AS docs_per_call,
  array_to_string(list_transform(docs, lambda x: x.t || ':' || x.n), ',') AS documents_of_call""", "len(docs) > 0"),
    "collect_parallel": per_call("""len(docs) AS docs_per_call,
  array_to_string(list_transform(docs, lambda x: x.t), ',') AS documents_types,
  array_to_string(list_transform(docs, lambda x: x.n), ',') AS document_identifications""", "len(docs) > 0"),
    "collect_structs_elements": ivr("""SELECT calls_ivr_id, len(docs) AS length, (place - 1)::INT AS place,
  docs[place].t AS document_type, docs[place].n AS document_identification
FROM (SELECT *, unnest(range(1, len(docs) + 1)) AS place FROM facts)""", FACTS),
    "collect_parallel_elements": ivr("""SELECT calls_ivr_id, len(docs) AS n_types, len(docs) AS n_ids, (place - 1)::INT AS place,
  docs[place].t AS documents_types, docs[place].n AS document_identifications
FROM (SELECT *, unnest(range(1, len(docs) + 1)) AS place FROM facts)""", FACTS),
    "collect_values": per_call("len(bills) AS bills_per_call, array_to_string(bills, ',') AS bills_per_register", "len(bills) > 0"),
    "collect_values_multi": per_call("len(bills) AS bills_per_call, array_to_string(bills, ',') AS bills_per_register", "len(bills) > 1"),
    "recency_flags": ivr("SELECT * FROM repeats", TIMELINES),
    "recency_report": ivr("""SELECT calls_ivr_id, calls_phone_number, calls_start_date, "repeated_phone_24H", "cause_recall_phone_24H",
  row_number() OVER (ORDER BY calls_ivr_id NULLS FIRST, calls_phone_number NULLS FIRST, calls_start_date NULLS FIRST) AS place
FROM repeats""", TIMELINES),
    "base_by_max": ivr("SELECT * FROM base", MAX_BASE),
    "best_row": ivr("SELECT * FROM base", BEST_BASE),
    "summary_max": summary(MAX_BASE),
    "summary_best_row": summary(BEST_BASE),
    "clean_int": CLEAN_INT,
    "clean_int_sql": CLEAN_INT,
    "drop_unknown": ivr("""SELECT * FROM det
WHERE 'UNKNOWN' NOT IN (document_type, document_identification, customer_phone)"""),
}

ALL_ORACLES: dict[str, str] = {**IVR_ORACLES}


# --- table model and validation ----------------------------------------------------
def _model_sql(model) -> str:
    parts = []

    def head(t, rule, cols):
        return f"SELECT '{t}' AS table_name, '{rule}' AS rule, '{cols}' AS columns, "

    def anynull(cols):
        return " OR ".join(f"{c} IS NULL" for c in cols)

    for spec in model:
        t = spec.name
        keys = ([(spec.primary_key, True)] if spec.primary_key else []) + [(u, False) for u in spec.unique]
        for cols, primary in keys:
            cl = ", ".join(cols)
            dup = f"WHEN NOT ({anynull(cols)}) AND n > 1 THEN n - 1"
            expr = (f"CASE WHEN {anynull(cols)} THEN n {dup} ELSE 0 END" if primary
                    else f"CASE {dup} ELSE 0 END")
            parts.append(head(t, "primary_key" if primary else "unique", ",".join(cols))
                         + f"CAST(COALESCE(SUM({expr}), 0) AS BIGINT) AS violations "
                         + f"FROM (SELECT {cl}, COUNT(*) AS n FROM {t} GROUP BY {cl}) g")
        for fk in spec.foreign_keys:
            on = " AND ".join(f"p.{pc} = c.{cc}" for cc, pc in zip(fk.columns, fk.parent_columns))
            nn = " AND ".join(f"c.{cc} IS NOT NULL" for cc in fk.columns)
            label = f"{','.join(fk.columns)}->{fk.parent}({','.join(fk.parent_columns)})"
            parts.append(head(t, "foreign_key", label)
                         + f"CAST(COUNT(*) AS BIGINT) AS violations FROM {t} c WHERE {nn} "
                         + f"AND NOT EXISTS (SELECT 1 FROM {fk.parent} p WHERE {on})")
        for c in spec.not_null:
            parts.append(head(t, "not_null", c)
                         + f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM {t}")
        for d in spec.domains:
            allowed = ", ".join(f"'{a.lower()}'" for a in d.allowed)
            parts.append(head(t, "check", d.column)
                         + f"CAST(COUNT(*) FILTER (WHERE {d.column} IS NOT NULL AND lower({d.column}) "
                         + f"NOT IN ({allowed})) AS BIGINT) AS violations FROM {t}")
        for c, n in spec.max_lengths.items():
            parts.append(head(t, "max_length", f"{c}({n})")
                         + f"CAST(COUNT(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) AS violations FROM {t}")
    return "\nUNION ALL\n".join(parts)


def _tpch_model():
    import os
    import sys
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from dialtone.sources.model import TPCH_MODEL
    return TPCH_MODEL


NOT_NULL_DETAIL_COLS = ["calls_vdn_label", "module_sequece", "step_sequence", "document_type",
                        "customer_phone", "step_description_error"]
LENGTH_LIMITS_DETAIL = {"calls_phone_number": 2, "document_identification": 3,
                        "billing_account_id": 4, "step_name": 20}

MODEL_ORACLES = {
    "typed_load": """SELECT o_orderkey::BIGINT AS o_orderkey, o_custkey::BIGINT AS o_custkey, o_orderstatus,
  o_totalprice::DOUBLE AS o_totalprice, o_orderdate::TIMESTAMP AS o_orderdate, o_orderpriority FROM orders""",
    "check_not_null": ivr("\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM det"
        for c in NOT_NULL_DETAIL_COLS)),
    "check_unique": """SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "check_primary_key": """SELECT o_orderkey, COUNT(*) AS n FROM orders GROUP BY 1
HAVING o_orderkey IS NULL OR COUNT(*) > 1""",
    "check_primary_key_detail": ivr("""SELECT step_sequence, count(*) AS n FROM det GROUP BY 1
HAVING step_sequence IS NULL OR count(*) > 1"""),
    "check_foreign_key": """SELECT * FROM orders o WHERE o.o_orderkey IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
    "check_foreign_key_lineitem": """SELECT * FROM lineitem l WHERE l.l_orderkey IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)""",
    "check_domain": """SELECT * FROM events WHERE event_type IS NOT NULL
AND lower(event_type) NOT IN ('click', 'view', 'purchase')""",
    "check_length": ivr("\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, {n} AS max_length, "
        f"CAST(COUNT(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) AS violations FROM det"
        for c, n in LENGTH_LIMITS_DETAIL.items())),
    "assign_key": ivr("""SELECT *, ROW_NUMBER() OVER (ORDER BY ivr_id, module_sequece, module_name,
  module_result) AS module_id FROM mods WHERE module_name <> 'HEADER'"""),
    "assign_key_continued": ivr("""SELECT * EXCLUDE (above, new) REPLACE (coalesce(module_id, above + new) AS module_id) FROM (
  SELECT *, max(module_id) OVER () AS above, row_number() OVER (PARTITION BY module_id IS NULL
    ORDER BY ivr_id, module_sequece, module_name, module_result) AS new
  FROM (SELECT *, CASE WHEN module_sequece % 2 = 0 THEN (ivr_id * 10 + module_sequece)::BIGINT END AS module_id
        FROM mods WHERE module_name <> 'HEADER'))"""),
    "validate_model": _model_sql(_tpch_model()),
}

ALL_ORACLES.update(MODEL_ORACLES)
