"""Nucleotide and protein sequences as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The standard genetic code, bases in the order T C A G.
_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = {a + b + c: _CODE[16 * i + 4 * j + k] for i, a in enumerate("TCAG") for j, b in enumerate("TCAG") for k, c in enumerate("TCAG")}

# What an ambiguous base may be.
IUPAC = {
    "A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC",
    "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT",
}

def _groups(**groups: str) -> dict[str, str]:
    return {amino: name for name, members in groups.items() for amino in members}


# Reduced protein alphabets, as groups of amino acids and the
# letter that each group becomes.  In the hydrophobicity alphabet I stands for
# hydrophobic residues and O for the others, as in use.
REDUCED = {
    "structural": _groups(A="ACGPSTWY", E="RNDQEHK", I="ILMFV"),
    "functional": _groups(A="DE", C="HKR", H="AFILMPVW", P="CGNQSTY"),
    "hydrophobic": _groups(I="AFILMPVW", O="CDEGHKNQRSTY"),
    "dayhoff": _groups(A="C", C="AGPST", D="DENQ", E="HKR", F="ILMV", G="FWY"),
    "sneath": _groups(A="ILV", C="AGP", D="MNQ", E="CST", F="DE", G="KR", H="FHWY"),
    "stanfel": _groups(A="ACGILMPSTV", C="DENQ", D="FWY", E="HKR"),
    "chemical": _groups(A="DE", L="AGILV", M="NQ", R="FWY", C="RHK", H="ST", I="P", S="CM"),
    "charge": _groups(A="DE", C="HKR", N="ACFGILMNPQSTVWY"),
}


def complement(c: Column) -> Column:
    return F.translate(c, "ACGTRYKMBDHVacgtrykmbdhv", "TGCAYRMKVHDBtgcayrmkvhdb")


def reverse_complement(c: Column) -> Column:
    return F.reverse(complement(c))


def reduce_alphabet(c: Column, name: str) -> Column:
    """Letters that no group has stay as they are."""
    table = REDUCED[name]
    return F.translate(c, "".join(table), "".join(table.values()))


def translate(c: Column, frame: int = 1) -> Column:
    """Amino acids of whole codons from ``frame`` (1, 2, 3) on; codons with
    other letters give X.  Shorter sequences give an empty text."""
    table = F.create_map(*[F.lit(x) for kv in CODONS.items() for x in kv])
    n = F.floor((F.length(c) - (frame - 1)) / 3)
    codons = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(c, i * 3 + frame, F.lit(3)))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.transform(codons, lambda x: F.coalesce(table[x], F.lit("X"))), "")


# Isotypes by codon, which may hold ambiguous bases.
ISOTYPES = {
    "GCN": "Ala", "TGY": "Cys", "GAY": "Asp", "GAR": "Glu", "TTY": "Phe", "GGN": "Gly", "CAY": "His", "ATH": "Ile",
    "AAR": "Lys", "TTR": "Leu", "CTN": "Leu", "ATG": "Met", "AAY": "Asn", "CCN": "Pro", "CAR": "Gln", "AGR": "Arg",
    "CGN": "Arg", "AGY": "Ser", "TCN": "Ser", "ACN": "Thr", "GTN": "Val", "TGG": "Trp", "TAY": "Tyr", "TAR": "Sup",
    "TGA": "SeC",
}


def plain_codons(codons: dict[str, str]) -> dict[str, str]:
    """Ambiguous codons spelt out; later entries win."""
    out: dict[str, str] = {}
    for codon, value in codons.items():
        some = [""]
        for base in codon.upper().replace("U", "T"):
            some = [x + b for x in some for b in IUPAC[base]]
        out |= dict.fromkeys(some, value)
    return out


def isotype(anticodon: Column, model: Column | None = None, alternates: dict[str, str] | None = None, undefined: str = "Undet") -> Column:
    """Isotype of an anticodon, whose reverse complement is looked up; an
    alternate code's entries go before the standard ones.  An ambiguous
    anticodon has the isotype that all its readings share, else none.  The
    selenocysteine codon is a suppressor but for models of its own (SeC)."""
    known = plain_codons(ISOTYPES) | plain_codons(alternates or {})
    table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    readings = F.transform(expand_ambiguous(reverse_complement(F.upper(anticodon)), 3), lambda c: table[c])
    own = F.coalesce(model == "SeC", F.lit(False)) if model is not None else F.lit(False)
    named = F.array_distinct(F.transform(readings, lambda t: F.when((t == "SeC") & ~own, "Sup").otherwise(F.coalesce(t, F.lit(undefined)))))
    return F.when(F.length(anticodon) != 3, undefined).when(F.size(named) == 1, named[0]).otherwise(undefined)


def acceptor_half(seq: Column, structure: Column, end: int) -> Column:
    """Seven bases of the acceptor stem at the 5' or the 3' end (``end`` 5 or
    3); a structure whose last pair has eleven unpaired places behind it has
    the 3' half further from the end."""
    if end == 5:
        return F.substring(seq, 1, 7)
    from_end = F.when(structure.endswith("<..........."), 11).otherwise(8)
    return F.substring(seq, F.length(seq) - from_end + 1, F.lit(7))


def alignment_score(a: Column, b: Column, match: int = 2, mismatch: int = -3, gap_open: int = -5, gap_extend: int = -2) -> Column:
    """Score of two aligned nucleotide sequences of one length.  A gap opens
    where the residue before it, in the gapped sequence, isn't a gap; a column
    of two gaps opens unless the column before it is one too; before the first
    column stands a gap."""
    x, y = F.split(a, ""), F.split(b, "")
    before = lambda s: F.concat(F.array(F.lit("-")), F.slice(s, 1, F.size(s) - 1))
    columns = F.arrays_zip(x.alias("x"), y.alias("y"), before(x).alias("px"), before(y).alias("py"))

    def one(c: Column) -> Column:
        gx, gy = c["x"] == "-", c["y"] == "-"
        opens = F.when(gx & gy, ~((c["px"] == "-") & (c["py"] == "-"))).when(gy, c["py"] != "-").otherwise(c["px"] != "-")
        return F.when(~gx & ~gy, F.when(c["x"] == c["y"], match).otherwise(mismatch)).otherwise(F.when(opens, gap_open).otherwise(gap_extend))

    return F.aggregate(columns, F.lit(0), lambda s, c: s + one(c))


def open_frames(protein: Column, shortest: int = 80) -> Column:
    """Stretches between stops and unknown residues, in order, of at least
    ``shortest`` residues."""
    return F.filter(F.split(protein, "[*X]+"), lambda s: F.length(s) >= shortest)


def expand_ambiguous(c: Column, length: int) -> Column:
    """All plain sequences that an ambiguous one of ``length`` may be."""
    table = F.create_map(*[x for k, v in IUPAC.items() for x in (F.lit(k), F.array(*[F.lit(b) for b in v]))])
    out = F.array(F.lit(""))
    for i in range(1, length + 1):
        bases = F.coalesce(table[F.substring(c, i, 1)], F.array(F.substring(c, i, 1)))
        out = _cross(out, bases)
    return out


def _cross(prefixes: Column, bases: Column) -> Column:
    return F.flatten(F.transform(prefixes, lambda p: F.transform(bases, lambda b: F.concat(p, b))))


def ambiguous_count(c: Column) -> Column:
    """How many plain sequences an ambiguous one stands for."""
    table = F.create_map(*[x for k, v in IUPAC.items() for x in (F.lit(k), F.lit(len(v)).cast("bigint"))])
    return F.aggregate(F.split(c, ""), F.lit(1).cast("bigint"), lambda n, b: n * F.coalesce(table[b], F.lit(1).cast("bigint")))


def iupac_pattern(c: Column) -> Column:
    """A regular expression that matches what an ambiguous sequence may be."""
    classes = F.create_map(*[x for k, v in IUPAC.items() for x in (F.lit(k), F.lit(v if len(v) == 1 else f"[{v}]"))])
    return F.array_join(F.transform(F.split(c, ""), lambda b: F.coalesce(classes[b], b)), "")


def lift(start: Column, end: Column, window_start: Column, window_end: Column, strand: Column) -> tuple[Column, Column]:
    """Window-local 1-based coordinates on the genome, for both strands."""
    plus = strand == "+"
    return (
        F.when(plus, window_start + start - 1).otherwise(window_end - end + 1),
        F.when(plus, window_start + end - 1).otherwise(window_end - start + 1),
    )


def upstream(start: Column, end: Column, gap: int, length: int, wrap: int = 100_000) -> tuple[Column, Column]:
    """The region before a gene, whose start exceeds its end on the reverse
    strand; a gene that seems longer than ``wrap`` runs over the origin."""
    forward = start < end
    forward = F.when(F.abs(end - start) + 1 > wrap, ~forward).otherwise(forward)
    sign = F.when(forward, 1).otherwise(-1)
    return start - sign * (gap + length), start - sign * (gap + 1)


def kimura(differences: Column) -> Column:
    """Protein distance from the share of differing sites; NaN beyond 0.8541."""
    return F.when(differences < 0.8541, -F.log(1 - differences - 0.2 * differences * differences)).otherwise(F.lit(float("nan")))


def identity_counts(a: Column, b: Column) -> Column:
    """struct(same, different, gaps) of two aligned sequences."""
    marks = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when((x == "-") | (y == "-"), "g").when(x == y, "s").otherwise("d"))
    n = lambda k: F.size(F.filter(marks, lambda m: m == k))
    return F.struct(n("s").alias("same"), n("d").alias("different"), n("g").alias("gaps"))
