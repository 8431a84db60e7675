"""Registered data-quality queries and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import quality as dq
from strata.plans import gold
from strata.plans.catalog_gold import SQL_G, silver_inputs
from strata.registry import register
from strata.sources import landing

# The event vocabulary of the given events table.
ALLOWED_EVENT_TYPES = ["signup", "purchase", "error", "view", "click"]

GOLD_NULL_COLUMNS = ["user_id", "signup_date", "device_type", "country",
                     "transaction_id", "time_to_purchase_seconds"]


def _gold(spark, sf_dir):
    e, t, u, bound = silver_inputs(spark, sf_dir)
    return gold.user_session_analysis(e, t, u, bound, stamp=False), u


def gold_rules(users):
    return [
        dq.is_unique("session_id"),
        dq.is_complete("user_id"),
        dq.values_in("first_event_type", ALLOWED_EVENT_TYPES),
        dq.min_value("session_duration_seconds", 0),
        dq.column_relation("end_not_before_start", "session_end_time",
                           F.col("session_end_time") >= F.col("session_start_time")),
        dq.referential("user_id", users, "user_id"),
    ]


_G = SQL_G
_IN = ", ".join(f"'{v}'" for v in ALLOWED_EVENT_TYPES)

_RULE_SQL = {
    "is_unique": """SELECT 'is_unique' AS rule, 'session_id' AS column, count(*) AS checked,
       count(*) - count(DISTINCT session_id) - CASE WHEN count(*) > count(session_id) THEN 1 ELSE 0 END
         AS violations FROM g""",
    "is_complete": """SELECT 'is_complete' AS rule, 'user_id' AS column, count(*) AS checked,
       count(*) FILTER (WHERE user_id IS NULL) AS violations FROM g""",
    "values_in": f"""SELECT 'values_in' AS rule, 'first_event_type' AS column, count(*) AS checked,
       count(*) FILTER (WHERE first_event_type IS NOT NULL AND first_event_type NOT IN ({_IN}))
         AS violations FROM g""",
    "min_value": """SELECT 'min_value' AS rule, 'session_duration_seconds' AS column, count(*) AS checked,
       count(*) FILTER (WHERE session_duration_seconds < 0) AS violations FROM g""",
    "column_relation": """SELECT 'end_not_before_start' AS rule, 'session_end_time' AS column,
       count(*) AS checked, count(*) FILTER (WHERE session_end_time < session_start_time) AS violations
FROM g""",
    "referential": """SELECT 'referential' AS rule, 'user_id' AS column, count(*) AS checked,
       count(*) FILTER (WHERE g.user_id IS NOT NULL AND g.user_id NOT IN (SELECT user_id FROM users))
         AS violations FROM g""",
}

_ALL_RULES_SQL = "\nUNION ALL ".join(_RULE_SQL.values())


def _rules_sql(body: str) -> str:
    return f"{_G}\nSELECT *, violations = 0 AS passed FROM ({body})"


@register("dq_rules", _rules_sql(_ALL_RULES_SQL))
def q_dq_rules(spark, sf_dir):
    g, u = _gold(spark, sf_dir)
    return dq.run_rules(g, gold_rules(u))


@register("fail_fast", _rules_sql(_ALL_RULES_SQL))
def q_fail_fast(spark, sf_dir):
    """The gate before a gold write: raises if any rule fails."""
    g, u = _gold(spark, sf_dir)
    return dq.fail_fast(dq.run_rules(g, gold_rules(u)))


@register("validate_schema", """SELECT * FROM (VALUES ('amount', 'double'), ('currency', 'missing'))
  AS t("column", problem), (SELECT count(*) AS checked FROM events WHERE event_type = 'purchase')""")
def q_validate_schema(spark, sf_dir):
    """Columns of the purchases that a declared schema finds missing or of
    another type, beside the rows they concern."""
    from pyspark.sql import types as T
    t = landing.app_transactions(spark, sf_dir).drop("currency")
    expected = T.StructType([T.StructField("transaction_id", T.LongType()), T.StructField("amount", T.DecimalType(10, 2)),
                             T.StructField("currency", T.StringType())])
    bad = dq.validate_schema(t, expected)
    problems = [F.struct(F.lit(c).alias("column"), F.lit(dict(t.dtypes).get(c, "missing")).alias("problem")) for c in sorted(bad)]
    return t.agg(F.count(F.lit(1)).alias("checked")).select(F.inline(F.array(*problems)), "checked")


def _one_rule(kind: str, idx: int):
    def q(spark, sf_dir):
        g, u = _gold(spark, sf_dir)
        return dq.run_rules(g, [gold_rules(u)[idx]])
    q.__name__ = f"q_rule_{kind}"
    return q


for _i, _kind in enumerate(_RULE_SQL):
    register(f"rule_{_kind}", _rules_sql(_RULE_SQL[_kind]))(_one_rule(_kind, _i))


_NULLS_SQL = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS null_count,
       coalesce(round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / nullif(count(*), 0), 2), 0.0)
         AS null_percentage FROM g""" for c in GOLD_NULL_COLUMNS)


@register("check_nulls", f"{_G}\n{_NULLS_SQL}")
def q_check_nulls(spark, sf_dir):
    g, _ = _gold(spark, sf_dir)
    return dq.check_nulls(g, GOLD_NULL_COLUMNS)


@register("check_duplicates", """SELECT count(*) AS total_rows, count(DISTINCT text) +
       CASE WHEN count(*) > count(text) THEN 1 ELSE 0 END AS distinct_keys,
       count(*) - count(DISTINCT text) - CASE WHEN count(*) > count(text) THEN 1 ELSE 0 END AS duplicates
FROM documents""")
def q_check_duplicates(spark, sf_dir):
    """Exact copies among whole document texts."""
    return dq.check_duplicates(landing.table(spark, sf_dir, "documents"), ["text"])


@register("summary_stats", """SELECT count(*) AS total_rows, 6 AS total_columns,
       'event_id,ts,user_id,event_type,value,props' AS columns FROM events""")
def q_summary_stats(spark, sf_dir):
    return dq.summary_stats(landing.table(spark, sf_dir, "events"))


@register("column_samples", "\nUNION ALL ".join(
    f"""SELECT '{c}' AS column, (SELECT count(DISTINCT {c}) FROM events) AS distinct_count,
       (SELECT string_agg(v, '|' ORDER BY n DESC, v) FROM (
          SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM events WHERE {c} IS NOT NULL
          GROUP BY {c} ORDER BY n DESC, v LIMIT 3)) AS samples""" for c in ("event_type", "user_id", "event_id")))
def q_column_samples(spark, sf_dir):
    """Distinct counts and the three most frequent values of columns."""
    p = dq.column_profile(landing.table(spark, sf_dir, "events"), ["event_type", "user_id", "event_id"], exact=True, samples=3)
    return p.select("column", "distinct_count", F.array_join("sample_values", "|").alias("samples"))


_PROFILE_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@register("column_profile", "\nUNION ALL ".join(
    f"""SELECT '{c}' AS column, count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count,
       count(DISTINCT {c}) AS distinct_count, CAST(min({c}) AS VARCHAR) AS min_value,
       CAST(max({c}) AS VARCHAR) AS max_value FROM events""" for c in _PROFILE_COLS))
def q_column_profile(spark, sf_dir):
    return dq.column_profile(landing.table(spark, sf_dir, "events"), _PROFILE_COLS, exact=True)
