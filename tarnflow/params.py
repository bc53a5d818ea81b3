"""Named parameters of the operators, with a prefix for session settings."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import SparkSession

PREFIX = "spark.tarnflow."


@dataclass(frozen=True)
class Params:
    """Defaults; ``from_session`` overrides them by spark.tarnflow.<name>."""

    query_coverage: float = 0.6
    subject_coverage: float = 0.6
    least_identity: float = 0.4
    most_identity: float = 1.0
    long_alignment: float = 100.0
    strict: bool = True
    max_hits: int = 100
    form_factor: float = 0.2
    least_word_count: int = 1
    cluster_cut: float = 0.7
    block_column: str = "qpid"
    best_cluster_only: bool = True
    #: Predictors whose terms are reported, parted by commas in a setting.
    predictors: tuple[str, ...] = ("rm3", "share", "jac", "hyge")

    @classmethod
    def from_session(cls, spark: SparkSession) -> "Params":
        out = cls()
        for f in fields(cls):
            value = spark.conf.get(PREFIX + f.name, None)
            if value is not None:
                kind = type(getattr(out, f.name))
                out = replace(out, **{f.name: value.lower() == "true" if kind is bool else tuple(value.split(",")) if kind is tuple else kind(value)})
        return out
