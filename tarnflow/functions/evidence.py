"""Evidence codes of annotations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How far an annotation of each evidence code is trusted.
WEIGHTS = {
    "IDA": 1.0, "IMP": 1.0, "IGI": 1.0, "IPI": 1.0, "IEP": 1.0, "TAS": 0.9, "NAS": 0.8, "IC": 0.9, "ISS": 0.8,
    "RCA": 0.8, "IEA": 0.7, "ND": 0.5, "NR": 0.5, "IBA": 0.8, "IGC": 0.7, "IRD": 0.7, "IKR": 0.8, "ISM": 0.8,
    "EXP": 1.0, "ISO": 0.8, "ISA": 0.8, "HDA": 1.0, "HMP": 1.0, "HGI": 1.0, "HPI": 1.0, "HEP": 1.0,
}
UNKNOWN = 0.5


def weight(code: Column) -> Column:
    """A code's weight; unknown and missing codes have UNKNOWN."""
    table = F.create_map(*[F.lit(x) for kv in WEIGHTS.items() for x in kv])
    return F.coalesce(table[code], F.lit(UNKNOWN))


def chosen(code: Column, include: tuple[str, ...] = (), exclude: tuple[str, ...] = ()) -> Column:
    """Codes among ``include`` (all if it is empty) and not among ``exclude``."""
    ok = code.isin(*include) if include else F.lit(True)
    return ok & ~code.isin(*exclude) if exclude else ok


def terms(cell: Column, include: tuple[str, ...] = (), exclude: tuple[str, ...] = ()) -> Column:
    """Distinct sorted ids of a list cell ``category|id|evidence,...`` whose
    evidence is chosen; what isn't of that form is left out."""
    parts = F.filter(F.transform(F.split(cell, ","), lambda x: F.split(F.trim(x), r"\|")), lambda p: F.size(p) == 3)
    kept = F.filter(parts, lambda p: chosen(p[2], include, exclude))
    return F.array_sort(F.array_distinct(F.transform(kept, lambda p: p[1])))


def clean_category(cell: Column) -> Column:
    """A category list without brackets, quotes and unicode marks."""
    return F.regexp_replace(cell, r"""[\[\]u'"]+""", "")
