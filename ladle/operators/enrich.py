"""User-function hooks over Arrow batches.

The only place ladle runs Python per row: a caller's own function (for
example a client for a model service) applied with ``mapInPandas``, so rows
move in Arrow batches and every partition runs in parallel.  Concurrency is
the number of partitions; ``batch`` is the slice handed to the function.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str | T.StructType) -> DataFrame:
    """``fn`` maps a pandas batch to a pandas batch with ``schema``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def enrich(df: DataFrame, fn: Callable[[list], list], col: str, keep: list[str],
           result_type: str = "string", batch: int = 48) -> DataFrame:
    """``fn`` takes a list of values and returns a list of results of the same length.

    ``fn`` reports a row that fails by returning the exception in its place: that row yields
    ``(result=NULL, error=<exception name: message>)`` and no other row is called again.  Only if
    ``fn`` itself raises are the batch's rows called one by one, to find the failing ones (a paid
    client should return its errors).  Results must fit ``result_type``; one that does not fails the job.
    """
    schema = ", ".join([f"{c} {df.schema[c].dataType.simpleString()}" for c in keep]
                       + [f"result {result_type}", "error string"])

    def one(v):
        try:
            r = fn([v])[0]
            return (None, f"{type(r).__name__}: {r}") if isinstance(r, Exception) else (r, None)
        except Exception as e:  # noqa: BLE001 - the error is the result
            return None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = pdf[col].tolist()
            results, errors = [], []
            for start in range(0, len(values), batch):
                chunk = values[start:start + batch]
                try:
                    out = list(fn(chunk))
                    if len(out) != len(chunk):
                        raise ValueError("result length differs from batch length")
                    failed = [isinstance(r, Exception) for r in out]
                    results += [None if bad else r for r, bad in zip(out, failed)]
                    errors += [f"{type(r).__name__}: {r}" if bad else None for r, bad in zip(out, failed)]
                except Exception:  # noqa: BLE001 - isolate the failing rows
                    for v in chunk:
                        r, e = one(v)
                        results.append(r)
                        errors.append(e)
            out = pdf[keep].copy()
            out["result"] = results
            out["error"] = errors
            yield out
    return df.select(*dict.fromkeys(keep + [col])).mapInPandas(run, schema)
