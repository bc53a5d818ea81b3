"""Quality scores by a regularised quadratic discriminant.

Features are transformed document statistics.  Each class has a mean and a
covariance shrunk towards the pooled one and towards a multiple of the unit
matrix; a document's score is the logistic of the difference of the classes'
log densities, whose Mahalanobis terms come from Cholesky factors computed
once.  Moments are sums over all labelled rows, so no row leaves the cluster.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .textstats import statistics


def _share(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1)).cast("double")


def features() -> list[Column]:
    """Transformed to be of the order of one and roughly symmetric."""
    root = lambda c: F.sqrt(c)
    return [
        F.log1p(F.col("n_words").cast("double")) / 2,
        F.log1p(_share("word_chars", "n_words")) * 4,
        root(_share("n_symbols", "n_words")) * 4,
        root(_share("n_dup_lines", "n_lines")) * 2,
        root(_share("n_repeat_words", "n_words")) * 3,
        F.log(_share("n_distinct_words", "n_words") + 0.01) * 2,
        root(_share("n_upper", "n_letters")) * 4,
        root(_share("n_digits", "n_chars")) * 4,
        root(_share("n_punctuation", "n_chars")) * 6,
        F.log1p(F.col("longest_word").cast("double")),
        root(_share("top_word", "n_words")) * 3,
        _share("packed_bytes", "n_bytes") * 4,
        F.log1p(_share("n_words", "n_lines")) / 2,
    ]


@dataclass(frozen=True)
class Discriminant:
    means: np.ndarray  # class, feature
    whiten: np.ndarray  # class, inverse Cholesky factor
    constant: np.ndarray  # class: log prior and log determinant


def shrunk(cov: np.ndarray, pooled: np.ndarray, to_pooled: float, to_unit: float) -> np.ndarray:
    mixed = (1 - to_pooled) * cov + to_pooled * pooled
    d = len(mixed)
    return (1 - to_unit) * mixed + to_unit * (np.trace(mixed) / d + 1e-6) * np.eye(d)


def fit(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], size: int, to_pooled: float, to_unit: float) -> Discriminant:
    """moments: class -> (rows, sum, sum of outer products).  A class without
    rows takes the pooled moments, so scores are then the prior's."""
    n = {k: moments[k][0] if k in moments else 0.0 for k in (0, 1)}
    total = sum(n.values())
    all_sum = sum((m[1] for m in moments.values()), np.zeros(size))
    all_outer = sum((m[2] for m in moments.values()), np.zeros((size, size)))
    grand = all_sum / max(total, 1)
    spread = all_outer / max(total, 1) - np.outer(grand, grand) if total else np.eye(size)
    means, covs = [], []
    for k in (0, 1):
        if n[k]:
            mean = moments[k][1] / n[k]
            means.append(mean)
            covs.append(moments[k][2] / n[k] - np.outer(mean, mean))
        else:
            means.append(grand)
            covs.append(spread)
    pooled = sum(n[k] * covs[k] for k in (0, 1)) / total if total else spread
    white, constant = [], []
    for k in (0, 1):
        factor = np.linalg.cholesky(shrunk(covs[k], pooled, to_pooled, to_unit))
        white.append(np.linalg.solve(factor, np.eye(size)))
        constant.append(np.log((n[k] + 1) / (total + 2)) - np.log(np.diag(factor)).sum())
    return Discriminant(np.array(means), np.array(white), np.array(constant))


def log_odds(model: Discriminant, x: list[Column]) -> Column:
    """Class 1 against class 0, as a column expression: each Mahalanobis term
    is the squared length of (inverse factor) (x - mean)."""
    vector = F.array(*x)
    terms = []
    for k in (0, 1):
        bias = -(model.whiten[k] @ model.means[k])
        rows = F.array(*[F.struct(F.array(*[F.lit(float(v)) for v in row]).alias("w"), F.lit(float(b)).alias("b")) for row, b in zip(model.whiten[k], bias)])
        terms.append(
            F.lit(float(model.constant[k]))
            - 0.5
            * F.aggregate(
                rows,
                F.lit(0.0),
                lambda total, row: total + F.pow(F.aggregate(F.zip_with(row["w"], vector, lambda a, b: a * b), row["b"], lambda s, v: s + v), F.lit(2.0)),
            )
        )
    return terms[1] - terms[0]


def train(labelled: DataFrame, names: list[str], to_pooled: float = 0.05, to_unit: float = 0.01) -> Discriminant:
    """From rows with ``names`` and quality 0 or 1 (others are left out): one
    aggregation, two rows to the driver."""
    d = len(names)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = [F.sum(names[i]).alias(f"s{i}") for i in range(d)]
    outer = [F.sum(F.col(names[i]) * F.col(names[j])).alias(f"o{i}_{j}") for i, j in pairs]
    rows = labelled.filter(F.col("quality").isin(0, 1)).groupBy("quality").agg(F.count(F.lit(1)).alias("n"), *sums, *outer).collect()
    moments = {}
    for r in rows:
        o = np.zeros((d, d))
        for i, j in pairs:
            o[i, j] = o[j, i] = r[f"o{i}_{j}"]
        moments[int(r["quality"])] = (float(r["n"]), np.array([r[f"s{i}"] for i in range(d)]), o)
    return fit(moments, d, to_pooled, to_unit)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, fold: int = 2, folds: int = 4) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Labels are learnt from rows whose crc32(doc_id as text) mod ``folds`` is
    not ``fold``.  Null texts are read as empty and are scored as such; null
    labels are left out, and without any label of a class scores follow the
    prior; very long texts are read whole; rows that repeat are scored alike;
    an empty table gives an empty result; only doc_id, text and quality are
    read.
    """
    x = features()
    names = [f"x{i}" for i in range(len(x))]
    stats = statistics(docs, ["doc_id"])
    table = materialise(stats.select("doc_id", *[c.alias(n) for c, n in zip(x, names)]), "features")
    table = table.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False)))
    known = labels.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("quality"))
    model = train(table.filter(~F.col("held_out")).join(known, F.col("doc_id") == F.col("label_id")), names)
    score = 1 / (1 + F.exp(-log_odds(model, [F.col(n) for n in names])))
    return table.select("doc_id", "held_out", score.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
