"""Golden rows for the validator (V1-V14) and the tolerant parse."""

import json

from ladle.operators.validate import validate

# The optional fields in the order in which a warning names them.
OPTIONAL = ("description, prepTime, cookTime, totalTime, recipeYield, recipeCategory, recipeCuisine, keywords, "
            "recipeIngredient, recipeInstructions")

FULL = {
    "@context": "https://schema.org", "@type": "Recipe", "name": "Oat Biscuits",
    "description": "Crunchy oat biscuits", "recipeIngredient": ["1 cup oats", "half a cup butter"],
    "recipeInstructions": [{"@type": "HowToStep", "text": "Mix"}, {"@type": "HowToStep", "text": "Bake"}],
    "prepTime": "PT10M", "cookTime": "PT15M", "totalTime": "PT25M", "recipeYield": "12 biscuits",
    "recipeCategory": "Snack", "recipeCuisine": "Scottish", "keywords": "oats, biscuits",
}


def run(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, j string")
    return {r.id: r for r in validate(df, "j").collect()}


def test_optional_fields_are_named_in_order(spark):
    """From the rule: a warning lists every optional key that is not there, in declared order, present or not null."""
    names = OPTIONAL.split(", ")
    docs = [{k: v for k, v in FULL.items() if k not in names[:n]} for n in range(len(names) + 1)]
    r = run(spark, [json.dumps(d) for d in docs] + [json.dumps({**FULL, **dict.fromkeys(names)})])
    for n in range(len(names) + 1):
        assert r[n].is_valid and r[n].errors == []
        assert r[n].warnings == ([f"Missing optional fields: {', '.join(names[:n])}"] if n else [])
    assert r[len(docs)].is_valid and r[len(docs)].warnings == []


def test_cut_documents_are_repaired_at_every_bracket(spark):
    """From the repair rule: cut after any value, a document keeps what stands before the cut."""
    whole = json.dumps(FULL)
    cuts = [i + 1 for i, c in enumerate(whole) if c in "}]" or whole[i:i + 3] == '", ']
    for cut, row in zip(cuts, run(spark, [whole[:c] for c in cuts]).values()):
        assert row.outcome == ("ok" if cut == len(whole) else "repaired"), whole[:cut]
        kept = json.loads(row.json_text)
        assert list(kept) == list(FULL)[:len(kept)]
        assert all(kept[k] == FULL[k] for k in list(kept)[:-1])  # the last value may be cut inside its list


def test_rules(spark):
    base = dict(FULL)
    cases = {
        "no_name": ({k: v for k, v in base.items() if k != "name"}, ["Missing required fields: name"], []),
        "type": ({**base, "@type": "Article"}, ["@type must be 'Recipe', got 'Article'"], []),
        "type_num": ({**base, "@type": 3}, ["@type must be a string"], []),
        "context": ({**base, "@context": "http://schema.org"}, [],
                    ["@context is 'http://schema.org', expected 'https://schema.org'"]),
        "name_null": ({**base, "name": None}, [], []),
        "name_num": ({**base, "name": 5}, ["name must be a string"], []),
        "blank_desc": ({**base, "description": "  \t"}, [], ["description is empty"]),
        "ingr_str": ({**base, "recipeIngredient": "flour"}, ["recipeIngredient must be an array"], []),
        "ingr_mixed": ({**base, "recipeIngredient": ["flour", 2, None]},
                       ["recipeIngredient[1] must be a string", "recipeIngredient[2] must be a string"], []),
        "ingr_empty": ({**base, "recipeIngredient": []}, [], ["recipeIngredient is empty"]),
        "steps": ({**base, "recipeInstructions": ["stir", {"text": "x"}, {"@type": "Step", "text": 1},
                                                  {"@type": None, "text": " "}]},
                  ["recipeInstructions[0] must be an object", "recipeInstructions[1] missing @type field",
                   "recipeInstructions[2] @type must be 'HowToStep', got 'Step'", "recipeInstructions[2] text must be a string",
                   "recipeInstructions[3] @type must be 'HowToStep', got 'None'"],
                  ["recipeInstructions[3] text is empty"]),
        "dur": ({**base, "prepTime": "15 minutes", "cookTime": "PT", "totalTime": 5}, ["totalTime must be a string"],
                ["prepTime should be in ISO 8601 duration format (e.g., 'PT15M'), got '15 minutes'",
                 "cookTime appears to be incomplete: 'PT'"]),
    }
    names = list(cases)
    r = run(spark, [json.dumps(cases[n][0]) for n in names])
    for i, n in enumerate(names):
        _, errors, warnings = cases[n]
        assert r[i].errors == errors, n
        assert r[i].warnings == warnings, n
        assert r[i].is_valid == (errors == []), n


def test_roots_and_repairs(spark):
    texts = ['[{"@context": "https://schema.org"}]', '"just text"', "", "nothing here", '{"a": 1} trailing',
             '```json\n{"@context":"https://schema.org","@type":"Recipe","name":"X",}\n```', '{"name": "x", "a": [1, 2',
             '{"a": NaN}']
    r = run(spark, texts)
    assert r[0].errors == ["Recipe JSON must be an object/dictionary"]
    assert r[1].errors == ["Recipe JSON must be an object/dictionary"]
    assert r[2].outcome == "rejected" and not r[2].is_valid
    assert r[3].outcome == "rejected"
    assert r[4].outcome == "repaired"          # trailing text is not accepted as is
    assert r[5].outcome == "repaired" and r[5].is_valid
    assert r[6].outcome == "repaired" and r[6].json_text.endswith("]}")
    assert r[7].outcome == "rejected"


def test_judge_example_shape(spark):
    doc = {k: v for k, v in FULL.items() if k not in ("recipeCuisine", "keywords")}
    r = run(spark, [json.dumps(doc)])
    assert r[0].is_valid and r[0].warnings == ["Missing optional fields: recipeCuisine, keywords"]


def test_valid_iff_no_errors(spark, sf_dir):
    import __spark_entry__ as E
    df = E.queries()["validate_docs"](spark, sf_dir)
    bad = df.filter("(n_errors = 0) <> is_valid").count()
    assert bad == 0
