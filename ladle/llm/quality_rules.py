"""Quality rules as a short-circuit cascade.

Each rule is a SQL condition that rejects a text.  On a sample the cost of each rule
(seconds of a job that evaluates only it) and its selectivity (share rejected) are
estimated, and rules are ordered by rejection per cost.  The cascade is one CASE: a
text that one rule rejects is not evaluated by the rules after it.  The verdict does
not depend on the order, so estimates only change the time.

The base counts take words as runs without ASCII white space.  Words in repeated
3-word windows are found without leaving the row: windows are sorted as packed numbers
(hash in the high bits, position in the low bits), equal neighbours are compared word by
word, and a text where a hash clashes or that is too long to pack is sorted by the words
themselves.

Defined cases: a null text counts as empty (no words, so it fails the base); null ids
are kept; repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SAMPLE_ROWS, SAMPLE_PARTS = 4000, 8
POSITION_BITS = 20

# name -> condition that rejects; columns: text, words (array), n_words, word_chars, n_symbols, n_dup_lines
RULES: dict[str, str] = {
    "symbols": "n_symbols > 0.25 * n_words",
    "word_length": "word_chars < 2 * n_words OR word_chars > 20 * n_words",
    "duplicate_lines": "2 * n_dup_lines > size(split(text, '\\n'))",
    "shouting": r"2 * length(regexp_replace(text, '[^\\p{Lu}]+', '')) > word_chars",
    "digits": r"3 * length(regexp_replace(text, '[^0-9]+', '')) > word_chars",
    "few_letters": r"2 * length(regexp_replace(text, '[^\\p{L}]+', '')) < word_chars",
    "one_word": "5 * size(array_distinct(words)) < n_words AND n_words < 400",
    "ellipses": r"3 * size(regexp_extract_all(text, '(\\.\\.\\.|\u2026)[ \\t]*(\\n|$)', 0)) > size(split(text, '\\n'))",
    "bullets": r"10 * size(regexp_extract_all(text, '(?m)^[ \\t]*[-\u2022][ \\t]', 0)) > 9 * size(split(text, '\\n'))",
}


def _covered(starts: Column) -> Column:
    """Positions covered by 3-word windows at these (ascending) starts."""
    steps = F.transform(starts, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - p, F.lit(3))))
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)


def with_base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, words and the base counts of every document."""
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    d = d.withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    d = d.withColumn("lines", lines)
    n = F.size("words")
    starts = F.slice("words", F.lit(1), F.greatest(n - 2, F.lit(0)))
    d = d.withColumn("windows", F.transform(starts, lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))))
    low = (1 << POSITION_BITS) - 1
    packed = F.sort_array(F.transform("windows", lambda h, i: h.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("bigint"))))
    d = d.withColumn("packed", F.when((F.size(F.array_distinct("windows")) < F.size("windows")) & (n <= low), packed))

    def same(a, b):
        hit = F.get("words", a) == F.get("words", b)
        for k in (1, 2):
            hit = hit & (F.get("words", a + k) == F.get("words", b + k))
        return hit

    def at(x):
        return x.bitwiseAND(F.lit(low)).cast("int")

    def twin(x, y):
        return F.coalesce(F.shiftright(x, POSITION_BITS) == F.shiftright(y, POSITION_BITS), F.lit(False))
    runs = F.filter("packed", lambda x, k: twin(x, F.get("packed", k + 1)) | twin(x, F.get("packed", k - 1)))
    d = d.withColumn("runs", runs)
    clash = F.exists(F.transform("runs", lambda x, k: twin(x, F.get("runs", k + 1)) & ~same(at(x), at(F.get("runs", k + 1)))),
                     lambda bad: F.coalesce(bad, F.lit(False)))
    plain = F.sort_array(F.transform("windows", lambda h, i: F.struct(F.slice("words", i + 1, 3).alias("w"), i.alias("i"))))
    d = d.withColumn("plain", F.when((n > low) | F.coalesce(clash, F.lit(False)), plain))
    d = d.withColumn("starts", F.sort_array(F.coalesce(
        F.transform(F.filter("plain", lambda x, k: F.coalesce(x["w"] == F.get("plain", k + 1)["w"], F.lit(False))
                             | F.coalesce(x["w"] == F.get("plain", k - 1)["w"], F.lit(False))), lambda x: x["i"]),
        F.transform("runs", at), F.array().cast("array<int>"))))
    return d.select(
        "doc_id", "text", "words", n.cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _covered(F.col("starts")).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def estimate(sample: DataFrame, rules: dict[str, str]) -> list[tuple[str, float, float]]:
    """(rule, seconds, share rejected) of each rule, evaluated alone over the sample."""
    sample.agg(F.count(F.lit(1))).first()  # the first read is not a rule's cost
    out = []
    for name, condition in rules.items():
        began = time.perf_counter()
        r = sample.agg(F.avg(F.expr(condition).cast("double")).alias("share")).first()
        out.append((name, time.perf_counter() - began, r["share"] or 0.0))
    return out


def order_rules(estimates: list[tuple[str, float, float]]) -> list[str]:
    """Rule names by falling rejection per cost (ties: name)."""
    return [n for n, _, _ in sorted(estimates, key=lambda e: (-e[2] / max(e[1], 1e-6), e[0]))]


def cascade(order: list[str], rules: dict[str, str]) -> Column:
    """Name of the first rule, in this order, that rejects; null if none does."""
    out = None
    for name in order:
        hit = F.expr(rules[name])
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out if out is not None else F.lit(None).cast("string")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict[str, str] | None = None,
          sample_rows: int = SAMPLE_ROWS, seed: int = 42) -> DataFrame:
    """Base counts, base_failed and kept of every document; the sample only orders the rules."""
    from ladle.llm.common import scratch_table
    rules = RULES if rules is None else rules
    counts = with_base_counts(docs, id_col, text_col)
    n = docs.count()
    drawn = docs.sample(fraction=min(1.0, sample_rows / max(n, 1)), seed=seed).repartition(SAMPLE_PARTS)
    sample = scratch_table(with_base_counts(drawn, id_col, text_col), "rule-sample")
    order = order_rules(estimate(sample, rules))
    failed = counts.withColumn("base_failed", base_failed())
    rejected = F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(order, rules))
    return failed.withColumn("kept", rejected.isNull()).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
