"""Queries: tolerant parse, rule validation, evaluation summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.functions import jsondoc as J
from ladle.operators import summary as S
from ladle.operators.validate import findings, sql_validate_ctes, validate
from ladle.plans.catalog import register
from ladle.plans.views import with_views, v_recipe_json

_VALIDATED_COLS = """doc_id, k, outcome, errors IS NOT NULL AND len(errors) = 0 AS is_valid,
  CAST(len(errors) AS BIGINT) AS n_errors, CAST(len(warnings) AS BIGINT) AS n_warnings,
  array_to_string(errors, chr(10)) AS errors, array_to_string(warnings, chr(10)) AS warnings"""


def _flat(df):
    return df.select("doc_id", "k", "outcome", "is_valid",
                     F.size("errors").cast("bigint").alias("n_errors"),
                     F.size("warnings").cast("bigint").alias("n_warnings"),
                     F.array_join("errors", "\n").alias("errors"),
                     F.array_join("warnings", "\n").alias("warnings"))


def _sql_validated(rules=None) -> list[tuple[str, str]]:
    return sql_validate_ctes("v_recipe_json", "doc_id, k", "json_text", rules)


def _validated_sql(select: str, rules=None) -> str:
    return with_views(select, "v_recipe_json", extra=_sql_validated(rules))


@register("validate_docs", _validated_sql(f"SELECT {_VALIDATED_COLS} FROM validated"))
def validate_docs(spark, sf_dir):
    """Every recipe document validated: outcome, validity and messages."""
    return _flat(validate(v_recipe_json(spark, sf_dir), "json_text"))


for _key, _rules, _ids in [("validate_required", ("required",), "V3"), ("validate_optional", ("optional",), "V4"),
                           ("validate_context", ("context",), "V5"), ("validate_type", ("type",), "V6"),
                           ("validate_strings", ("string",), "V7"), ("validate_ingredients", ("ingredients",), "V8"),
                           ("validate_instructions", ("instructions",), "V9-V11"),
                           ("validate_durations", ("duration",), "V12")]:
    def _make(rules, ids):
        def q(spark, sf_dir):
            return _flat(validate(v_recipe_json(spark, sf_dir), "json_text", rules=rules))
        q.__doc__ = f"{ids} (with V1, V2, V13): only the {'/'.join(rules)} rule over every recipe document."
        return q
    register(_key, _validated_sql(f"SELECT {_VALIDATED_COLS} FROM validated", _rules))(_make(_rules, _ids))


@register("eval_summary", _validated_sql(
    "SELECT count(*) AS total_samples, count(*) FILTER (WHERE len(errors) = 0) AS valid_count, "
    "count(*) FILTER (WHERE len(errors) > 0) AS invalid_count, "
    "CASE WHEN count(*) > 0 THEN round(CAST(count(*) FILTER (WHERE len(errors) = 0) AS DOUBLE) * 100.0 / count(*), 6) ELSE 0.0 END AS valid_percentage "
    "FROM validated"))
def eval_summary(spark, sf_dir):
    """F6 over all recipe documents: share valid."""
    return S.eval_summary(validate(v_recipe_json(spark, sf_dir), "json_text", warnings=False))


@register("error_histogram", _validated_sql(
    "SELECT regexp_replace(m, '\\[\\d+\\]', '[i]', 'g') AS message, count(*) AS n "
    "FROM (SELECT unnest(errors) AS m FROM validated) GROUP BY 1"))
def error_histogram(spark, sf_dir):
    """F8: error messages by frequency."""
    return S.error_histogram(validate(v_recipe_json(spark, sf_dir), "json_text", warnings=False))


@register("validate_findings", _validated_sql(
    "SELECT doc_id, 'error' AS level, CAST(p - 1 AS INTEGER) AS pos, errors[p] AS message "
    "FROM (SELECT doc_id, errors, unnest(range(1, len(errors) + 1)) AS p FROM validated) "
    "UNION ALL "
    "SELECT doc_id, 'warning' AS level, CAST(p - 1 AS INTEGER) AS pos, warnings[p] AS message "
    "FROM (SELECT doc_id, warnings, unnest(range(1, len(warnings) + 1)) AS p FROM validated)"))
def validate_findings(spark, sf_dir):
    """Long form, one row per message."""
    return findings(validate(v_recipe_json(spark, sf_dir), "json_text"), ["doc_id"])


@register("json_route", _validated_sql(
    "SELECT doc_id, k, outcome, json_text, length(json_text) AS n_chars FROM validated"))
def json_route(spark, sf_dir):
    """Each document routed ok / repaired / rejected with the text that parsed."""
    df = J.parse_tolerant(v_recipe_json(spark, sf_dir), "json_text", doc="doc", outcome="outcome", text="parsed")
    return df.select("doc_id", "k", "outcome", F.col("parsed").alias("json_text"),
                     F.length("parsed").cast("bigint").alias("n_chars"))
