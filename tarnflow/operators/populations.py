"""Population and alignment statistics."""

from __future__ import annotations

from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import written


def fst(alleles: DataFrame, population: str, marker: str, allele: str) -> DataFrame:
    """Wright's fixation index of haploid data for each marker, by variance
    components over populations."""
    counts = alleles.groupBy(marker, allele, population).agg(F.count(F.lit(1)).alias("k"))
    sizes = alleles.groupBy(marker, population).agg(F.count(F.lit(1)).alias("n"))
    # An allele that a population lacks has frequency 0 there.
    grid = counts.select(marker, allele).distinct().join(sizes, marker)
    p = grid.join(counts, [marker, allele, population], "left").withColumn("p", F.coalesce("k", F.lit(0)) / F.col("n"))
    r = F.count(F.lit(1)).alias("r")
    by_allele = p.groupBy(marker, allele).agg(
        r, F.avg("n").alias("nbar"), F.sum("n").alias("ntot"), F.sum(F.col("n") * F.col("n")).alias("n2"), (F.sum(F.col("n") * F.col("p")) / F.sum("n")).alias("pbar"),
        F.sum(F.col("n") * F.col("p") * (1 - F.col("p"))).alias("within"), F.sum(F.col("n") * F.col("p") * F.col("p")).alias("np2"),
    )
    between = (F.col("np2") - F.col("ntot") * F.col("pbar") * F.col("pbar")) / (F.col("r") - 1)
    inside = F.col("within") / (F.col("ntot") - F.col("r"))
    nc = (F.col("ntot") - F.col("n2") / F.col("ntot")) / (F.col("r") - 1)
    parts = by_allele.filter("r > 1").withColumn("num", between - inside).withColumn("den", between + (nc - 1) * inside)
    return parts.groupBy(marker).agg(F.try_divide(F.sum("num"), F.sum("den")).alias("fst"))


def codon_usage(codons: DataFrame, codon: str) -> DataFrame:
    """(codon, n, per_thousand)."""
    counts = codons.groupBy(codon).agg(F.count(F.lit(1)).alias("n"))
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("__t")))).select(codon, "n", (1000.0 * F.col("n") / F.col("__t")).alias("per_thousand"))


def sites(alignment: DataFrame, individual: str, seq: str, group: list[str] = [], gap: str = "-") -> DataFrame:  # noqa: B006
    """(group, site, individual, allele) of the alignment's columns that vary:
    at least two different residues besides gaps; sites count from 1."""
    each = alignment.select(*group, individual, F.posexplode(F.split(F.upper(seq), "")).alias("site", "allele")).withColumn("site", F.col("site") + 1).filter(F.col("allele") != "")
    # By different alleles, of which a site has few: the least of strings would sort all.
    alleles = each.filter(F.col("allele") != gap).select(*group, "site", "allele").distinct()
    varied = alleles.groupBy(*group, "site").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(*group, "site")
    # Stored, their number is known: if they are few, as of long sequences in few
    # groups, they go to all tasks, and no site's alleles are gathered and sorted.
    varied = written(varied)
    return each.join(varied, [*group, "site"], "left_semi").select(*group, "site", individual, "allele")


def tag_markers(haplotypes: DataFrame, group: str, haplotype: str, marker: str, allele: str) -> DataFrame:
    """(group, markers): every smallest set of markers that tells all of a
    group's different haplotypes apart.  Sets are tried by size, so a group (a
    region's few common haplotypes) is one task's work."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        wide = p.pivot_table(index=haplotype, columns=marker, values=allele, aggfunc="min").drop_duplicates()
        names = sorted(wide.columns)
        for size in range(1, len(names) + 1):
            found = [list(c) for c in combinations(names, size) if not wide[list(c)].duplicated().any()]
            if found:
                return pd.DataFrame({group: [p[group].iloc[0]] * len(found), "markers": found})
        return pd.DataFrame({group: [], "markers": []})

    few = haplotypes.select(group, haplotype, marker, allele)
    kind = few.schema[marker].dataType.simpleString()
    return few.groupBy(group).applyInPandas(run, f"{group} {few.schema[group].dataType.simpleString()}, markers array<{kind}>")


def families(members: DataFrame, family: str, member: str) -> DataFrame:
    """(family, size, members) with each member once, sorted."""
    return members.groupBy(family).agg(F.array_sort(F.collect_set(member)).alias("members")).withColumn("size", F.size("members"))


def enzymes(df: DataFrame, name: str, site: str, cut: str) -> DataFrame:
    """Adds an enzyme's site length, whether it cuts blunt (in the middle of
    its site) and whether its site is a palindrome."""
    from tarnflow.functions.sequences import reverse_complement

    length = F.length(site)
    return df.withColumns({"site_length": length, "blunt": 2 * F.col(cut) == length, "palindrome": F.col(site) == reverse_complement(F.col(site))})


def longest_cutters(collection: DataFrame, length: str = "site_length") -> DataFrame:
    """The enzymes with the longest site."""
    top = collection.agg(F.max(length).alias("__top"))  # one row
    return collection.join(F.broadcast(top), F.col(length) == F.col("__top")).drop("__top")
