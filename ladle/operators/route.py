"""Outcome routing of extraction records (D4) and the example builder that obeys it.

An extraction without a result is ``failed``; text that does not parse, or a result that is
neither falsy nor an object, is ``error``; a falsy result (``{}``, ``[]``, ``""``, 0, false,
null) is ``empty``; a filled object is ``good``.  Only ``good`` records become examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions import jsondoc as J
from ladle.operators.pairing import pair
from ladle.operators.render import training_example

GOOD = "good"


def outcome(recipe_json: str = "recipe_json") -> Column:
    text = F.col(recipe_json)
    doc = J.parse_strict(text)
    kind = J.kind(doc)
    falsy = ((kind == "null") | ((kind == "object") & (F.schema_of_variant(doc) == "OBJECT<>"))
             | ((kind == "array") & (F.size(F.try_variant_get(doc, "$", "array<variant>")) == 0))
             | ((kind == "string") & (F.variant_get(doc, "$", "string") == ""))
             | ((kind == "number") & (F.try_variant_get(doc, "$", "double") == 0))
             | ((kind == "boolean") & ~F.coalesce(F.try_variant_get(doc, "$", "boolean"), F.lit(True))))
    return (F.when(text.isNull(), "failed").when(doc.isNull(), "error").when(falsy, "empty")
            .when(kind == "object", GOOD).otherwise("error"))


def sql_outcome(text: str = "recipe_json") -> str:
    kind = f"json_type({text})"
    return (f"CASE WHEN {text} IS NULL THEN 'failed' WHEN NOT {J.sql_parse_ok(text)} THEN 'error' "
            f"WHEN {kind} = 'OBJECT' THEN CASE WHEN len(json_keys({text})) = 0 THEN 'empty' ELSE 'good' END "
            f"WHEN {kind} = 'ARRAY' THEN CASE WHEN json_array_length({text}) = 0 THEN 'empty' ELSE 'error' END "
            f"WHEN {kind} IN ('NULL') OR trim({text}) IN ('\"\"', 'false') OR try_cast({text} AS DOUBLE) = 0 THEN 'empty' "
            "ELSE 'error' END")


def examples(records: DataFrame, blogs: DataFrame, system_prompt: str | None = None) -> DataFrame:
    """(stem, messages): the 3-message example of every record that is good and has a blog."""
    good = pair(records.where(outcome() == GOOD), blogs)
    return good.select("stem", training_example("text", "recipe_json", "reasoning", system_prompt).alias("messages"))
