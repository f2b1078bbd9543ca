"""Prompt, message and chat-template rendering.

All rendering is ``concat`` / ``transform`` / ``array_join`` over columns: one
narrow projection per step, no UDF.  Messages are
``array<struct<role:string, content:string>>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions.text import _c, py_strip, strip_reasoning

# The labelled lines of the generation prompt (B1) and its
# closing sentence; a missing value prints as None.
RECORD_PROMPT_LINES = [
    ("Name", "name"),
    ("Category", "group"),
    ("Rating", "rating"),
    ("Number of Raters", "n_rater"),
    ("Number of Reviewers", "n_reviewer"),
    ("Summary", "summary"),
    ("Process/Timing", "process"),
    ("Ingredients", "ingredient"),
]
RECORD_PROMPT_HEAD = "Recipe Information:"
RECORD_PROMPT_TAIL = "Generate the recipe content according to the style specified in the system prompt."

# Extraction prompt prefix (B2) and the judge prompt frame.
EXTRACT_PREFIX = "Extract recipe information from this text:\n\n"
JUDGE_BLOG_HEAD = "**BLOG POST:**\n```\n"
JUDGE_JSON_HEAD = "\n```\n\n**EXTRACTED RECIPE JSON:**\n```json\n"
JUDGE_TAIL = "\n```\n\nPlease evaluate the accuracy of this JSON extraction."

# Reasoning tags (B4) and the chat-template markers.
THINK_OPEN = "<think>"
THINK_CLOSE = "</think>"
TURN_OPEN = "<start_of_turn>"
TURN_CLOSE = "<end_of_turn>\n"
MODEL_ROLE = "model"
USER_MARK = "<start_of_turn>user\n"
MODEL_MARK = "<start_of_turn>model\n"

# Fixed value: the default system prompt of a training example.
DEFAULT_SYSTEM_PROMPT = """You are a recipe extraction assistant. Your task is to analyze the provided text and extract recipe information in LD-JSON format following the schema.org Recipe specification.

Given a piece of text that describes a cooking recipe (possibly including a long blog post, personal stories, comments, etc.), extract a single Recipe object in JSON-LD format.

Return ONLY valid JSON in the following format:
{
  "@context": "https://schema.org",
  "@type": "Recipe",
  "name": "Recipe Name",
  "description": "Recipe description",
  "recipeIngredient": ["quantity of ingredient 1", "quantity of ingredient 2", ...],
  "recipeInstructions": [
    {
      "@type": "HowToStep",
      "text": "Step 1 instruction"
    }
  ],
  "prepTime": "PT15M",
  "cookTime": "PT30M",
  "totalTime": "PT45M",
  "recipeYield": "4 servings",
  "recipeCategory": "Main Course",
  "recipeCuisine": "Italian",
  "keywords": "pasta, dinner"
}

Include as many fields as you can extract from the text. If you cannot find recipe information, return an empty object.

Do not include any explanatory text, only the JSON."""

def _none(c: Column) -> Column:
    """How an f-string prints a missing value."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def record_prompt(columns: dict[str, str] | None = None) -> Column:
    """B1: the generation prompt of a source record.  ``columns`` maps the
    record's field names (name, group, rating, ...) to column names."""
    columns = columns or {}
    parts = [F.lit(RECORD_PROMPT_HEAD)]
    for label, field in RECORD_PROMPT_LINES:
        parts.append(F.concat(F.lit(f"{label}: "), _none(F.col(columns.get(field, field)))))
    parts.append(F.lit(""))
    parts.append(F.lit(RECORD_PROMPT_TAIL))
    return F.concat_ws("\n", *parts)


def extraction_prompt(text, strip_header: bool = False) -> Column:
    """B2: the user turn asking for an extraction.

    By default the document is used as stored, style header included (as the
    reference does); ``strip_header=True`` removes that label from the text a
    model is trained on.
    """
    body = _c(text)
    if strip_header:
        from ladle.operators.synth import drop_header
        body = drop_header(body)
    return F.concat(F.lit(EXTRACT_PREFIX), _none(body))


def judge_prompt(blog, recipe_json) -> Column:
    """Blog in a plain fence, the JSON (as given, compact) in a json fence."""
    return F.concat(F.lit(JUDGE_BLOG_HEAD), _none(_c(blog)), F.lit(JUDGE_JSON_HEAD), _none(_c(recipe_json)), F.lit(JUDGE_TAIL))


def wrap_reasoning(reasoning) -> Column:
    """Non-empty reasoning not already opening with <think> is wrapped; else unchanged."""
    r = _c(reasoning)
    stripped = py_strip(r)
    return (F.when(r.isNotNull() & (r != "") & ~stripped.startswith(THINK_OPEN),
                   F.concat(F.lit(THINK_OPEN + "\n"), stripped, F.lit("\n" + THINK_CLOSE)))
            .otherwise(r))


def assistant_turn(reasoning, recipe_json) -> Column:
    """Wrapped reasoning, a blank line, the JSON text (NULL reasoning prints None)."""
    return F.concat(_none(wrap_reasoning(reasoning)), F.lit("\n\n"), _none(_c(recipe_json)))


def reasoning_flags(assistant) -> Column:
    """Flags for the two ways stripping does not undo wrapping: an empty reasoning
    leaves a leading blank line, and an unclosed <think> survives into the
    training text.  Count them with ``summary.outcome_counts`` style aggregates."""
    stripped = strip_reasoning(_c(assistant))
    return F.struct(stripped.startswith("\n\n").alias("leading_blank"),
                    stripped.contains(THINK_OPEN).alias("think_left"))


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def training_example(blog, recipe_json, reasoning, system_prompt: str | None = None,
                     strip_header: bool = False) -> Column:
    """The 3-message training example (system, user, assistant)."""
    return F.array(message("system", F.lit(system_prompt or DEFAULT_SYSTEM_PROMPT)),
                   message("user", extraction_prompt(blog, strip_header)),
                   message("assistant", assistant_turn(reasoning, recipe_json)))


def to_chat(messages) -> Column:
    """Keep messages 0, 1, 2 by position; reasoning stripped from the assistant turn.

    A missing position gives NULL content (``get``), never an exception.
    """
    m = _c(messages)

    def at(i: int, strip: bool = False) -> Column:
        item = F.get(m, i)
        content = strip_reasoning(item["content"]) if strip else item["content"]
        return F.struct(item["role"].alias("role"), content.alias("content"))
    return F.array(at(0), at(1), at(2, strip=True))


def chat_complete(messages) -> Column:
    """True when positions 0..2 exist (rows failing this are flagged, not dropped)."""
    return F.size(_c(messages)) >= 3


def render_chat(conversation, add_generation_prompt: bool = False) -> Column:
    """The chat template as one text.

    Each turn is ``<start_of_turn>ROLE\\n`` + stripped content + ``<end_of_turn>\\n``
    with the assistant shown as ``model``; a leading system message is folded
    into the first user turn as ``system + "\\n\\n"``; no ``<bos>``.  With
    ``add_generation_prompt`` assistant turns are left out and
    ``<start_of_turn>model\\n`` is appended.
    """
    conv = _c(conversation)
    if add_generation_prompt:
        conv = F.filter(conv, lambda x: x["role"] != "assistant")
    first = F.get(conv, 0)
    has_sys = F.coalesce(first["role"] == "system", F.lit(False))
    prefix = F.when(has_sys, F.concat(py_strip(first["content"]), F.lit("\n\n"))).otherwise(F.lit(""))
    rest = F.when(has_sys, F.slice(conv, 2, F.greatest(F.size(conv) - 1, F.lit(0)))).otherwise(conv)

    # the system text goes in front of the first user turn (the first turn if there is none)
    first_user = F.array_position(F.transform(rest, lambda m: m["role"]), "user")
    target = F.when(first_user > 0, first_user - 1).otherwise(F.lit(0))

    def turn(x: Column, i: Column) -> Column:
        role = F.when(x["role"] == "assistant", F.lit(MODEL_ROLE)).otherwise(x["role"])
        return F.concat(F.lit(TURN_OPEN), role, F.lit("\n"), F.when(i == target, prefix).otherwise(F.lit("")),
                        py_strip(F.coalesce(x["content"], F.lit(""))), F.lit(TURN_CLOSE))
    body = F.array_join(F.transform(rest, turn), "")
    return F.concat(body, F.lit(MODEL_MARK)) if add_generation_prompt else body


def nest_turns(df: DataFrame, key: str, order: str, role: str = "role", content: str = "content",
               out: str = "messages") -> DataFrame:
    """One row per conversation with its messages in turn order.

    A conversation is one training record, so its turns are gathered in one
    row by construction; the aggregation is hash-partitioned by conversation.
    """
    agg = df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(role).alias("role"),
                                                                      F.col(content).alias("content")))).alias("_t"))
    return agg.select(key, F.transform("_t", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias(out))


def unnest_turns(df: DataFrame, key: str, messages: str = "messages", order: str = "turn") -> DataFrame:
    """B11 inverse: one row per message with its 0-based position."""
    return (df.select(key, F.posexplode(messages).alias(order, "m"))
              .select(key, F.col(order).cast("bigint").alias(order), F.col("m.role").alias("role"), F.col("m.content").alias("content")))


def supervised_spans(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Character form of response-only training.

    Text is kept from the end of a ``<start_of_turn>model\n`` marker up to the
    next ``<start_of_turn>user\n`` marker; everything else, markers included,
    is masked.  The text is cut before every user marker, and each of those chunks before
    every ``<start_of_turn>`` (lookaheads, so no character is lost): inside a chunk everything
    from its first model turn on is kept.  Each step binds its arrays once, so the work is
    linear in the text, and a conversation is one row, so nothing is shuffled.  One row per
    segment: position, length, masked and kept characters.
    """
    chunks = F.transform(F.split(F.col(text), f"(?={USER_MARK})"), lambda c: F.struct(F.split(c, f"(?={TURN_OPEN})").alias("segs")))
    first = F.transform(chunks, lambda c: F.struct(
        c["segs"].alias("segs"), F.array_position(F.transform(c["segs"], lambda x: x.startswith(MODEL_MARK)), True).alias("model")))

    def segment(x: Column, i: Column, model: Column) -> Column:
        n = F.length(x)
        masked = F.when(x.startswith(MODEL_MARK), F.lit(len(MODEL_MARK))).when((model > 0) & (i >= model), F.lit(0)).otherwise(n)
        return F.struct(n.cast("bigint").alias("length"), masked.cast("bigint").alias("masked"), (n - masked).cast("bigint").alias("kept"))
    spans = F.flatten(F.transform(first, lambda c: F.transform(c["segs"], lambda x, i: segment(x, i, c["model"]))))
    return (df.select(key, F.posexplode(spans).alias("seg", "s"))
              .select(key, F.col("seg").cast("bigint").alias("seg"), "s.length", "s.masked", "s.kept").filter(F.col("length") > 0))
