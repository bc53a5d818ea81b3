"""Column functions over descriptions and other free text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Terms of uninformative descriptions and their penalties.
PENALTIES = {
    "UNCHARACTERI": 60, "WGS PROJECT": 44, "_": 60, "GENOMIC": 60, "WHOLE GENOME SHOTGUN": 80, "CONTIG": 60,
    "SCAFFOLD": 60, "PARTIAL": 14, "HYPOTHETICAL": 24, "CDNA": 16, "WGS": 16, "UNKNOWN": 14, "-LIKE": 10, "ORF": 6,
    "COMPLETE ": 60, "PREDICTED PROTEIN": 60, "LOCUS": 60, "SEQUENCE": 60, "HOMOLOG": 3, "ISOFORM": 4, "PUTATIVE": 12,
    "SIMILAR TO": 10, "FRAGMENT": 8, "PROBABLE": 8, "CHROMOSOME": 40, "POSSIBLE": 8, "CONSERVED": 9, "FAMILY": 6,
    "RELATED": 10,
}

# Words that say nothing about a description.
UNINFORMATIVE = [
    "HYPOTHETICAL", "UNCHARACTERIZED", "PUTATIVE", "CONTIG", "PREDICTED", "PROBABLE", "FRAGMENT", "GENOME", "PROTEIN",
    "CHROMOSOME", "POSSIBLE", "SIMILAR", "PROTEINS", "HOMOLOG", "CONSERVED", "HOMOLOGOUS", "COMPLETE", "SHOTGUN",
    "CDNA", "FAMILY",
]


def ascii_upper(c: Column | str) -> Column:
    """A-Z for a-z and nothing else: the same on any engine, for any language.
    On ASCII alone it is what upper does, at a fraction of the time."""
    slow = F.translate(c, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return F.when(F.octet_length(c) == F.char_length(c), F.upper(c)).otherwise(slow)


def clean_description(c: Column, drop_codes: bool = False, upper=F.upper) -> Column:
    """Upper-cased description without tag tail, brackets and punctuation.

    A description left as one word with a digit becomes HYPOTHETICAL PROTEIN;
    ``drop_codes`` removes words that mix letters and digits.  ``upper`` is
    the upper-casing of letters.  Null stays null.
    """
    t = F.regexp_replace(F.trim(c), r" \w{2}=.*$", "")
    t = F.regexp_replace(t, r"[()\[\]{}]", "")
    t = F.regexp_replace(t, r"""["/=\\:;,|%.#!<>?_'^+-]""", " ")
    words = F.filter(F.split(t, r"\s+"), lambda w: w != "")
    if drop_codes:
        kept = F.array_join(F.filter(words, lambda w: ~(w.rlike("[0-9]") & w.rlike("[A-Za-z]"))), " ")
        many = F.when(F.size(words) > 1, kept).otherwise(t)
    else:
        many = t
    coded = (F.size(words) == 1) & t.rlike("[0-9]")
    return F.trim(upper(F.when(coded, F.lit("Hypothetical protein")).otherwise(many)))


def form_factor(c: Column, upper=F.upper) -> Column:
    """Share of a description that informs: one less the penalties for other
    characters than letters, for codes and for the terms above, over length.
    Empty and null texts have 0.  ``upper`` is the upper-casing of letters.

    The penalty lies in no branch and no lambda, so Spark upper-cases a text once;
    a match of a code goes on to its word's end, so that a word counts once."""
    t = upper(c)
    penalty = F.lit(3.0) + 2.0 * F.length(F.regexp_replace(t, r"[A-Z '-]+", ""))
    penalty = penalty + 4.0 * F.regexp_count(t, F.lit(r"[A-Z][0-9]\S*"))
    penalty = penalty + 4.0 * F.regexp_count(t, F.lit(r"[0-9][A-Z]\S*"))
    penalty = penalty + F.when(t.startswith("PROTEIN"), 12.0).otherwise(0.0) + F.when(t.endswith("PROTEIN"), 12.0).otherwise(0.0)
    for term, weight in PENALTIES.items():
        penalty = penalty + F.when(t.contains(term), float(weight)).otherwise(0.0)
    return F.coalesce(1.0 - F.try_divide(penalty, F.length(c)), F.lit(0.0))


def informative_words(words: Column) -> Column:
    return F.filter(words, lambda w: ~w.isin(UNINFORMATIVE))


def split_accession(c: Column) -> Column:
    """The accession of db|acc|id; any other text as it is."""
    return F.coalesce(F.try_element_at(F.split(c, r"\|"), F.lit(2)), c)


def tag_value(c: Column, tag: str) -> Column:
    """The value of a two-letter tag (OS=, GN=, ...) in a header; null if none."""
    return F.nullif(F.regexp_extract(c, rf"(?:^|\s){tag}=(.*?)(?=\s[A-Z]{{2}}=|$)", 1), F.lit(""))


def ec_member(c: Column, group: str) -> Column:
    """Whether an EC number lies in a group such as 1.2.-.-: levels that the
    group leaves open match anything."""
    levels = group.split(".")
    ok = F.lit(True)
    for i, level in enumerate(levels):
        if level != "-":
            ok = ok & (F.try_element_at(F.split(c, r"\."), F.lit(i + 1)) == level)
    return F.coalesce(ok, F.lit(False))


def wrap(c: Column, width: int = 60) -> Column:
    """Line ends after every ``width`` characters, none at the end."""
    return F.regexp_replace(F.regexp_replace(c, f"(.{{{width}}})", "$1\n"), r"\n$", "")


def safe_percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 where whole is 0."""
    return F.coalesce(F.try_divide(F.lit(100.0) * part, whole), F.lit(0.0))


def subsequence_length(a: list, b: list) -> int:
    """Length of the longest common subsequence: one big-integer step for each
    element of b, which adds carries over the places where it occurs in a."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full
    for x in b:
        at = free & places.get(x, 0)
        free = ((free + at) | (free - at)) & full
    return len(a) - free.bit_count()


def _subsequence_lengths(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else subsequence_length(list(x), list(y)) for x, y in zip(a, b)], dtype="Int64")


def common_subsequence(a: str, b: str) -> Column:
    """Length of the longest common subsequence of two text or array columns."""
    return F.pandas_udf(_subsequence_lengths, "long")(a, b)


def changes(a: Column, b: Column, common: Column) -> Column:
    """struct(removed, added): what turns a into b, by the least edit script."""
    return F.struct((F.length(a) - common).alias("removed"), (F.length(b) - common).alias("added"))
