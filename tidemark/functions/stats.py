"""Paired statistics. Each works on one bounded pair of per-query lists, so it is an Arrow function of two arrays."""

from __future__ import annotations

import math
import random

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED = 20260801  # fixed value


def bootstrap(values: list[float], resamples: int = 2000, confidence: float = 0.95, seed: int = SEED) -> tuple[float, float]:
    """Percentile interval of the mean; (0, 0) for no values."""
    if not len(values):
        return 0.0, 0.0
    rng = random.Random(seed)
    n = len(values)
    means = sorted(sum(values[rng.randrange(n)] for _ in range(n)) / n for _ in range(resamples))
    tail = (1 - confidence) / 2
    return means[int(tail * resamples)], means[min(int((1 - tail) * resamples), resamples - 1)]


def permutation(a: list[float], b: list[float], n: int = 100_000, seed: int = SEED) -> tuple[float, float]:
    """Mean difference and the two-sided share of random sign changes that reach it.

    Signs come from one stream of the standard generator, a draw below 0.5 for plus, so p-values can be reproduced.
    """
    if len(a) != len(b) or not len(a):
        raise ValueError("two lists of the same length, not empty")
    import numpy as np

    d = np.asarray(a, float) - np.asarray(b, float)
    mean = float(sum(d.tolist()) / len(d))
    draw = random.Random(seed).random
    reached = 0
    for at in range(0, n, 5000):
        rows = min(5000, n - at)
        plus = np.fromiter((draw() for _ in range(rows * len(d))), float, rows * len(d)).reshape(rows, -1) < 0.5
        reached += int((np.abs(np.where(plus, d, -d).sum(axis=1)) / len(d) >= abs(mean) - 1e-12).sum())
    return mean, (reached + 1) / (n + 1)


def rank_sum_counts(n: int) -> list[int]:
    """How many subsets of the ranks 1..n have each sum: the coefficients of (1 + x)(1 + x^2)...(1 + x^n)."""
    import numpy as np

    product = np.array([1], object)
    for r in range(1, n + 1):
        longer = np.concatenate([product, np.zeros(r, object)])
        longer[r:] += product
        product = longer
    return [int(c) for c in product]


def wilcoxon(a: list[float], b: list[float]) -> tuple[float, float]:
    """Median of all differences and the two-sided signed-rank p: exact without ties, else the corrected normal one."""
    if len(a) != len(b) or not len(a):
        raise ValueError("two lists of the same length, not empty")
    every = sorted(x - y for x, y in zip(a, b))
    n = len(every)
    median = (every[(n - 1) // 2] + every[n // 2]) / 2
    d = [x for x in every if x != 0]
    if not d:
        return 0.0, 1.0
    size = sorted(abs(x) for x in d)
    n = len(size)
    rank, ties, at = {}, [], 0
    while at < n:
        to = at
        while to < n and size[to] == size[at]:
            to += 1
        rank[size[at]] = (at + 1 + to) / 2
        ties.append(to - at)
        at = to
    up = sum(rank[abs(x)] for x in d if x > 0)
    w = min(up, n * (n + 1) / 2 - up)
    if max(ties) == 1:
        counts = rank_sum_counts(n)
        return median, min(1.0, 2 * sum(counts[: int(w) + 1]) / 2**n)
    mean = n * (n + 1) / 4
    var = n * (n + 1) * (2 * n + 1) / 24 - sum(t**3 - t for t in ties) / 48
    if var <= 0:
        return median, 1.0
    z = max(0.0, abs(w - mean) - 0.5) / math.sqrt(var)
    return median, min(1.0, math.erfc(z / math.sqrt(2)))


# types, not text: workers that import this module have no session to parse text with
_INTERVAL = T.StructType([T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType())])
_TEST = T.StructType([T.StructField("delta", T.DoubleType()), T.StructField("p", T.DoubleType())])


@F.pandas_udf(_INTERVAL)
def bootstrap_interval(values: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([bootstrap(list(v)) for v in values], columns=["low", "high"])


@F.pandas_udf(_TEST)
def permutation_test(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([permutation(list(x), list(y)) for x, y in zip(a, b)], columns=["delta", "p"])


@F.pandas_udf(_TEST)
def wilcoxon_test(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([wilcoxon(list(x), list(y)) for x, y in zip(a, b)], columns=["delta", "p"])


def paired(run, base, metrics: tuple[str, ...] = ("ndcg", "f1")):
    """(metric, delta, p_permutation, p_wilcoxon) over the queries that both have; no rows if they have none in common."""
    both = run.join(base.select("query_id", *[F.col(m).alias(f"_{m}") for m in metrics]), "query_id")
    rows = both.select("query_id", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("x"), F.col(f"_{m}").alias("y")) for m in metrics])).alias("r"))
    lists = rows.groupBy("r.metric").agg(F.array_sort(F.collect_list(F.struct("query_id", "r.x", "r.y"))).alias("v"))
    tested = lists.select("metric", permutation_test(F.col("v")["x"], F.col("v")["y"]).alias("t"), wilcoxon_test(F.col("v")["x"], F.col("v")["y"]).alias("w"))
    return tested.select("metric", F.round("t.delta", 4).alias("delta"), F.round("t.p", 4).alias("p_permutation"), F.round("w.p", 4).alias("p_wilcoxon"))
