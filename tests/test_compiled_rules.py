"""Validation's rules and white-space stripping stay in compiled code; results as before."""

from ladle.functions import text as T
from ladle.operators.validate import validate


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_generator_only_passes_messages_on(spark):
    plan = _plan(validate(spark.createDataFrame([(1, "{}")], "id int, t string").repartition(2), "t"))
    generators = [line for line in plan.split("\n") if "Generate inline" in line]
    assert generators and not any("must be" in line or "Missing" in line for line in generators)


def test_stripping_tries_no_pattern(spark):
    df = spark.createDataFrame([("  a b　\n",), (" ",), ("",), (None,)], "t string").repartition(2)
    out = df.select("t", T.py_strip("t").alias("s"), T.is_blank("t").alias("b"))
    assert "regexp" not in _plan(out).lower() and "rlike" not in _plan(out).lower()
    assert {r.t: (r.s, r.b) for r in out.collect()} == {
        "  a b　\n": ("a b", False), " ": ("", True), "": ("", True), None: (None, None)}


def test_messages_of_mixed_lists(spark):
    steps = '[{"@type":"HowToStep","text":"a"},null,"s",{"text":" "},{"@type":null,"text":3},{"@type":5}]'
    doc = f'{{"@context":"https://schema.org","@type":"Recipe","name":"n","recipeIngredient":["a",null,2],"recipeInstructions":{steps}}}'
    row = validate(spark.createDataFrame([(doc,)], "t string"), "t").select("errors", "warnings").first()
    assert row.errors == [
        "recipeIngredient[1] must be a string", "recipeIngredient[2] must be a string",
        "recipeInstructions[1] must be an object", "recipeInstructions[2] must be an object",
        "recipeInstructions[3] missing @type field", "recipeInstructions[4] @type must be 'HowToStep', got 'None'",
        "recipeInstructions[4] text must be a string", "recipeInstructions[5] @type must be 'HowToStep', got '5'",
        "recipeInstructions[5] missing text field"]
    assert row.warnings[-1] == "recipeInstructions[3] text is empty"
