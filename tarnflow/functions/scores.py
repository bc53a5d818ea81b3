"""Statistical scores as column expressions."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def logmod(x: Column) -> Column:
    return F.when(x > 1, 1 + F.log(x)).when(x < -1, -1 - F.log(-x)).otherwise(x)


def hyper_mean(n: Column, k: Column, m: Column) -> Column:
    """Expected members of a class of n among k drawn from m."""
    return n * k / m


def hyper_variance(n: Column, k: Column, m: Column) -> Column:
    e = hyper_mean(n, k, m)
    return e * (1 - n / m) * (m - k) / (m - 1)


def gsz(sample: Column, score: Column, mean: Column, variance: Column, size: Column, total: Column) -> Column:
    """Gene set z-score of a class: how far its summed score is from what a
    random class of that size would have.  Classes below 2 have 0, below 10
    count as 10; a sample of one gives mean times variance of the draw."""
    n = F.greatest(size, F.lit(10)).cast("double")
    e, v = hyper_mean(n, sample, total), hyper_variance(n, sample, total)
    spread = variance * (e * (sample - e) - v) / F.nullif(sample - 1, F.lit(0)) + mean * mean * v
    z = F.try_divide(score - mean * e, F.sqrt(spread))
    many = F.when(F.coalesce(F.isnan(z) | z.isNull(), F.lit(True)), 0.0).otherwise(z)
    return F.when(size < 2, 0.0).when(sample > 1, many).otherwise(e * v)


# Calibration curves from scores to precision.
def ppv_description(x: Column, eukaryote: Column | bool = False) -> Column:
    euk = F.when(x < 0.705, F.greatest(F.lit(0.0), -1.253 + 2.295 * x)).when(x < 3.05855, F.least(F.lit(1.0), -0.05199 + 0.66827 * x - 0.10945 * x * x)).otherwise(0.9680758)
    bac = F.when(x < 1.322, F.greatest(F.lit(0.0), -0.5057 + 1.4713 * x - 0.3757 * x * x)).otherwise(F.least(F.lit(1.0), 0.77258 - 0.01382 * x + 0.01632 * x * x))
    return F.when(F.lit(eukaryote) if isinstance(eukaryote, bool) else eukaryote, euk).otherwise(bac)


def ppv_rm3(x: Column) -> Column:
    return F.when(x < 0.466, 0.1205 + 1.6223 * x).otherwise(F.least(F.lit(1.0), -0.5582 + 5.6307 * x - 5.4758 * x * x))


def ppv_share(x: Column) -> Column:
    z = F.sqrt(x)
    return F.when(x < 0, 0.0).when(z < 3.709538, 0.3047 + 0.1452 * z).otherwise(F.least(F.lit(1.0), 0.67302 + 0.04591 * z))


def ppv_jaccard(x: Column) -> Column:
    z = F.log(x)
    return F.when(x <= 0, 0.0).when(z >= -3.527961, F.least(F.lit(1.0), 0.89756 + 0.01835 * z)).otherwise(F.greatest(F.lit(0.0), 0.97768 + 0.04106 * z))


def ppv_hypergeometric(x: Column) -> Column:
    return F.least(F.lit(1.0), 0.32608 + 0.05392 * F.log(F.greatest(x, F.lit(1.0))))


def ppv_hypergeometric_exact(x: Column) -> Column:
    z = F.log(F.greatest(x, F.lit(1.0)))
    return F.when(z > 0.6155868, F.least(F.lit(1.0), 0.51099 + 0.06829 * z)).otherwise(F.greatest(F.lit(0.0), 0.2557 + 0.483 * z))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln gamma for x > 0, by the Stirling series after shifting x above 10."""
    x = np.asarray(x, np.float64).copy()
    shift = np.zeros_like(x)
    for _ in range(10):
        low = x < 10
        shift = np.where(low, shift + np.log(x), shift)
        x = np.where(low, x + 1, x)
    inv = 1 / x
    series = inv / 12 - inv**3 / 360 + inv**5 / 1260 - inv**7 / 1680 + inv**9 / 1188
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + series - shift


def hyper_tail(x: int, m: int, k: int, n: int) -> float:
    """P(X >= x) for X members of a class of n among k drawn from m; 1 where x
    is less than a standard deviation above the mean."""
    mean = n * k / m
    var = mean * (1 - n / m) * (m - k) / max(m - 1, 1)
    if x < mean + np.sqrt(max(var, 0)):
        return 1.0
    i = np.arange(x, min(k, n) + 1)
    i = i[m - k - n + i >= 0]
    if not len(i):
        return 0.0
    choose = lambda a, b: log_gamma(a + 1) - log_gamma(b + 1) - log_gamma(a - b + 1)
    one = np.ones(len(i))
    logs = choose(n * one, i) + choose((m - n) * one, k - i) - choose(m * one, k * one)
    top = logs.max()
    return float(min(1.0, np.exp(top) * np.exp(logs - top).sum()))


@lru_cache(maxsize=200_000)
def _tail(x: int, m: int, k: int, n: int) -> float:
    return hyper_tail(x, m, k, n)


def _tails(x: pd.Series, m: pd.Series, k: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([_tail(int(a), int(b), int(c), int(d)) for a, b, c, d in zip(x.tolist(), m.tolist(), k.tolist(), n.tolist())], dtype="float64")


def hypergeometric_p(x: str, m: str, k: str, n: str) -> Column:
    """hyper_tail of four columns; a worker keeps the last distinct rows, as a
    few make up most of a table."""
    return F.pandas_udf(_tails, "double")(x, m, k, n)


def hypergeometric_score(x: str, m: str, k: str, n: str) -> Column:
    """-ln of the tail, at most about 690; what can't happen has the most."""
    return -F.log(F.greatest(hypergeometric_p(x, m, k, n), F.lit(1e-300)))


# The coefficients of the regressions below.
def rm1(qcov: Column, scov: Column, pide: Column, taxdist: Column, accepted: Column, documented: bool = False) -> Column:
    """Regression score of a hit; 0 for hits that weren't accepted.  The terms
    are bound as in use; ``documented`` binds them by name."""
    a, b, c = (pide, qcov, scov) if documented else (qcov, scov, pide)
    return F.when(accepted, 0.21 * F.log10(100 * a) + 0.26 * b * c + 0.40 * c * taxdist).otherwise(0.0)


def rm2(value: Column, jaccard: Column, z: Column) -> Column:
    return 0.59 + 0.53 * logmod(value) + 0.02 * jaccard + 0.0004 * z


def class_scores(k: Column, b: Column, n: Column, bits: Column, total_bits: Column, root: Column, z: Column) -> dict[str, Column]:
    """Predictors of a class: k of n hits have it, b entries in the background,
    root entries in its ontology."""
    jsc = k / (b + n - k)
    return {
        "rm3": F.greatest(F.lit(0.0), 0.36 + 0.01 * F.log(jsc) + 0.02 * logmod(z) - 3.67e-5 * F.sqrt(b) - 0.007 * F.sqrt(n)),
        "share": bits / total_bits * F.log2(root / b),
        "jac": bits / total_bits * jsc,
        "bg": b / root,
        "voted": F.least(k / n, F.lit(0.99)),
    }
