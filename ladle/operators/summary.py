"""Counters and summaries.

All are global or low-cardinality aggregates: Spark computes them with a
partial (map-side) aggregate per partition and one tiny final merge, so a hot
group never gathers rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladle.functions.text import pct

INDEX_RE = r"\[\d+\]"


def eval_summary(validated: DataFrame) -> DataFrame:
    """total, valid, invalid and valid % over validated rows."""
    agg = validated.agg(F.count(F.lit(1)).alias("total_samples"),
                        F.count_if(F.col("is_valid")).alias("valid_count"))
    return agg.select(
        "total_samples", "valid_count",
        (F.col("total_samples") - F.col("valid_count")).alias("invalid_count"),
        pct("valid_count", "total_samples").alias("valid_percentage"))


def error_histogram(validated: DataFrame, col: str = "errors") -> DataFrame:
    """F8: how often each error message occurs, item indexes normalised to ``[i]``."""
    # explode_outer + filter on the generated column keeps the optimizer from
    # pushing an inferred size() filter into (and re-running) the rule projection
    msgs = (validated.select(F.explode_outer(col).alias("m")).filter(F.col("m").isNotNull())
                     .select(F.regexp_replace("m", INDEX_RE, "[i]").alias("message")))
    return msgs.groupBy("message").agg(F.count(F.lit(1)).alias("n"))


def outcome_counts(df: DataFrame, outcome: str = "outcome", kinds: tuple[str, ...] = ("success", "empty", "error")) -> DataFrame:
    """One counter column per outcome kind (zero when absent)."""
    return df.agg(*[F.count_if(F.col(outcome) == k).alias(f"{k}_count") for k in kinds],
                  F.count(F.lit(1)).alias("total"))


def style_distribution(df: DataFrame, style: str = "style") -> DataFrame:
    """F1 + D9: count and share of each style among successful rows, largest first."""
    counts = df.groupBy(style).agg(F.count(F.lit(1)).alias("count"))
    # the window runs over the aggregated rows: one per style, bounded by the catalogue
    total = F.sum("count").over(Window.partitionBy())
    return (counts.select(style, "count", pct(F.col("count"), total).alias("percentage"))
                  .orderBy(F.desc("count"), F.col(style)))


def mean_time(df: DataFrame, seconds: str = "seconds", group: str | None = None) -> DataFrame:
    """items, total and mean time (per group when given)."""
    aggs = [F.count(F.lit(1)).alias("items"), F.round(F.sum(seconds), 6).alias("total_seconds"),
            F.round(F.avg(seconds), 6).alias("mean_seconds")]
    return df.groupBy(group).agg(*aggs) if group else df.agg(*aggs)


def score_summary(df: DataFrame, overall: str = "overall", evaluated: str = "evaluated",
                  judge_error: str | None = None, errors_as_null: bool = False) -> DataFrame:
    """evaluated count and avg / min / max overall score (NULL when none).

    By default a failed judge call counts as evaluated with its overall score
    of 0, which pulls the average down (the reference's behaviour);
    ``errors_as_null=True`` leaves rows with ``judge_error`` out of the score
    statistics.
    """
    score = F.col(overall)
    if errors_as_null and judge_error:
        score = F.when(F.col(judge_error).isNull(), score)
    return df.agg(F.count_if(F.col(evaluated)).alias("vibes_evaluated_count"),
                  F.round(F.avg(score), 6).alias("vibes_avg_score"),
                  F.round(F.min(score), 6).alias("vibes_min_score"),
                  F.round(F.max(score), 6).alias("vibes_max_score"))


def run_row(spark, run: dict) -> DataFrame:
    """The one row of run metadata."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in run.items()])


def report_samples(checked: DataFrame, batches: DataFrame, judged: DataFrame, key: str = "sample_id") -> DataFrame:
    """One row per sample: its batch, its text, a struct of the validation and, where one was
    taken, a struct of the judge's result with the raw reply (NULL elsewhere)."""
    validation = F.struct("is_valid", "errors", "warnings").alias("structural_validation")
    judge = judged.select(key, F.struct(F.col("judge").alias("evaluation"), "raw_response").alias("vibes_evaluation"))
    return checked.select(key, "generated_json", validation).join(batches, key).join(judge, key, "left")
