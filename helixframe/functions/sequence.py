"""Scalars over protein and DNA sequences, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amino-acid classes of biochemical similarity.
AMINO_CLASS = {
    "G": 0, "A": 0, "V": 0, "L": 0, "I": 0,
    "F": 1, "W": 1, "Y": 1,
    "S": 2, "T": 2, "C": 2,
    "N": 3, "Q": 3, "H": 3,
    "D": 4, "E": 4,
    "K": 5, "R": 5,
    "P": 6, "M": 6,
}
# Three-letter amino-acid codes.
AMINO_CODE = {
    "Ala": "A", "Arg": "R", "Asn": "N", "Asp": "D", "Cys": "C", "Gln": "Q", "Glu": "E", "Gly": "G", "His": "H", "Ile": "I",
    "Leu": "L", "Lys": "K", "Met": "M", "Phe": "F", "Pro": "P", "Ser": "S", "Thr": "T", "Trp": "W", "Tyr": "Y", "Val": "V",
}
# Residue potentials of peptides; other letters count 1.0.
RESIDUE_POTENTIAL = {
    "A": 1.81, "C": 1.28, "D": 1.23, "E": 1.56, "F": 2.98, "G": 0.94, "H": 2.33, "I": 4.92, "K": 2.80, "L": 4.92, "M": 2.35,
    "N": 0.84, "P": 2.67, "Q": 1.46, "R": 1.76, "S": 1.60, "T": 2.57, "V": 4.04, "W": 2.33, "X": 1.0, "Y": 2.00,
}
# Species suffixes of entry names.
SPECIES_SUFFIXES = ("_HUMAN", "_MOUSE", "_RAT", "_DOG", "_CAT", "_WHALE", "_BAT", "_SHARK")


def let(value: Column, body) -> Column:
    """body(value), where body may use the value many times and in lambdas: it is worked out once a row."""
    return F.transform(F.array(value), body)[0]


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def letters(seq: Column) -> Column:
    """Array of characters; empty for an empty text."""
    return F.filter(F.split(seq, ""), lambda c: c != "")


def _pairs(a: Column, b: Column) -> Column:
    return F.arrays_zip(letters(a).alias("a"), letters(b).alias("b"))


def _count(array: Column, keep) -> Column:
    return F.size(F.filter(array, keep))


def window_divergence(animal: Column, human: Column) -> Column:
    """Share of differing positions among those that are not gaps in both; 0 for unequal lengths or no such position."""
    pairs = _pairs(animal, human)
    used = lambda p: ~((p["a"] == "-") & (p["b"] == "-"))
    n = _count(pairs, used)
    return F.when((F.length(animal) != F.length(human)) | (n == 0), 0.0).otherwise(_count(pairs, lambda p: used(p) & (p["a"] != p["b"])) / n)


def identity_percent(a: Column, b: Column) -> Column:
    """Percent of equal positions among those that are not gaps in both; unequal lengths raise."""
    pairs = _pairs(a, b)
    used = lambda p: ~((p["a"] == "-") & (p["b"] == "-"))
    n = _count(pairs, used)
    value = F.when(n == 0, 0.0).otherwise(100.0 * _count(pairs, lambda p: used(p) & (p["a"] == p["b"])) / n)
    return F.when(F.length(a) == F.length(b), value).otherwise(F.raise_error(F.lit("aligned sequences differ in length")).cast("double"))


def shingles(seq: Column, k: int) -> Column:
    """Distinct substrings of k characters; empty where the text is shorter."""
    at = F.when(F.length(seq) >= k, F.sequence(F.lit(1), F.length(seq) - (k - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: F.substring(seq, i, F.lit(k))))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct values."""
    both = F.struct(F.size(F.array_intersect(a, b)).alias("common"), (F.size(a) + F.size(b)).alias("sizes"))
    return let(both, lambda x: F.when(x["sizes"] == 0, 0.0).otherwise(x["common"] / (x["sizes"] - x["common"])))


def kmer_identity(a: Column, b: Column, k: int = 3, first: int = 300) -> Column:
    """Percent Jaccard similarity of k-mers of the first residues, gaps included; texts under k letters compare by position, and an empty one is 0."""
    clean = lambda s: F.substring(s, 1, first)

    def of(x: Column, y: Column) -> Column:
        n = F.greatest(F.length(x), F.length(y))
        same = _count(_pairs(x, y), lambda p: p["a"] == p["b"])
        alike = let(shingles(x, k), lambda s: let(shingles(y, k), lambda t: jaccard(s, t)))
        return F.when((F.length(x) == 0) | (F.length(y) == 0), 0.0).when((F.length(x) < k) | (F.length(y) < k), 100.0 * same / n).otherwise(100.0 * alike)

    return let(clean(a), lambda x: let(clean(b), lambda y: of(x, y)))


def window_starts(length: Column, size: int = 15, step: int = 5) -> Column:
    """0-based starts of windows that fit."""
    return F.when(length >= size, F.sequence(F.lit(0), length - size, F.lit(step))).otherwise(F.array().cast("array<int>"))


def label_species(label: Column) -> Column:
    """Species of a species|protein label; a label without a bar is both."""
    return F.split(label, "\\|", 2)[0]


def label_protein(label: Column) -> Column:
    parts = F.split(label, "\\|", 2)
    return F.coalesce(F.get(parts, 1), parts[0])


def variant_positions(query: Column, target: Column) -> Column:
    """0-based positions over the shorter text at which letters differ, case-insensitively."""
    n = F.least(F.length(query), F.length(target))
    q, t = letters(F.upper(query)), letters(F.upper(target))
    return F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get(q, i) != F.get(t, i))).otherwise(F.array().cast("array<int>"))


def conservation(percent_identity: Column, alignment_length: Column, region_length: Column) -> Column:
    return F.when(region_length <= 0, 0.0).otherwise(F.least(F.lit(1.0), percent_identity / 100.0 * alignment_length / region_length))


def symbol_before_underscore(name: Column) -> Column:
    return F.when(F.contains(name, F.lit("_")), F.substring_index(name, "_", 1)).otherwise(F.coalesce(name, F.lit("")))


def symbol_without_species(name: Column, suffixes: tuple[str, ...] = SPECIES_SUFFIXES) -> Column:
    return F.regexp_replace(name, "(?i)(" + "|".join(suffixes) + ")$", "")


def accession(raw: Column) -> Column:
    """A six or ten letter protein accession in a header, the part between bars first."""
    pattern = "([OPQ][0-9][A-Z0-9]{3}[0-9]|[A-NR-Z][0-9]([A-Z][A-Z0-9]{2}[0-9]){1,2})"
    bars = F.regexp_extract(raw, r"\|" + pattern + r"\|", 1)
    plain = F.regexp_extract(raw, r"(?:^|[|:\s])" + pattern + r"(?:$|[|:\s.-])", 1)
    return F.coalesce(F.nullif(bars, F.lit("")), F.nullif(plain, F.lit("")))


def hgvs_protein(change: Column) -> Column:
    """(ref, position, alt) of p.Ala123Val, null where it isn't one."""
    part = lambda i: F.regexp_extract(change, r"p\.([A-Z][a-z]{2})([0-9]+)([A-Z][a-z]{2})", i)
    code = literal_map(AMINO_CODE)
    ref, alt = F.try_element_at(code, part(1)), F.try_element_at(code, part(3))
    return F.when(ref.isNotNull() & alt.isNotNull(), F.struct(ref.alias("ref"), part(2).cast("int").alias("position"), alt.alias("alt")))


def amino_class(aa: Column) -> Column:
    return F.try_element_at(literal_map(AMINO_CLASS), F.upper(aa))


def similar_amino_acids(a: Column, b: Column) -> Column:
    return F.coalesce((a == b) | (amino_class(a) == amino_class(b)), F.lit(False))


# Fixed value: a guide's twenty bases before its motif.
PAM = "(?=([ACGT]{20}GG))"


def pam_sites(seq: Column, longest: int = 10000) -> Column:
    """Overlapping 20-mers before GG; 0 for texts over `longest`."""
    return F.when(seq.isNull() | (F.length(seq) > longest), 0).otherwise(F.size(F.regexp_extract_all(F.upper(seq), F.lit(PAM), F.lit(1))))


def guide_score(guide: Column) -> Column:
    """On-target heuristic of a 20-mer: GC share, seed, poly-T and end rules."""
    g = F.upper(guide)
    gc = (F.length(g) - F.length(F.translate(g, "GC", ""))) / F.length(g)
    parts = [
        F.when((gc >= 0.40) & (gc <= 0.70), 0.4), F.when(~F.contains(F.substring(g, 17, 4), F.lit("T")), 0.2), F.when(~F.contains(g, F.lit("TTTT")), 0.2),
        F.when(F.substring(g, 20, 1).isin("A", "G"), 0.1), F.when(F.substring(g, 1, 1) != "G", 0.1),
    ]
    return F.when(F.length(g) < 20, 0.0).otherwise(F.round(F.least(F.lit(1.0), reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0.0)) for p in parts])), 3))


def scored_guides(seq: Column, top: int = 50) -> Column:
    """(sites, mean_efficiency, risk): mean over the `top` best guides, risk by the number of sites."""
    sites = F.regexp_extract_all(F.upper(seq), F.lit(PAM), F.lit(1))
    scores = F.slice(F.sort_array(F.transform(sites, lambda s: guide_score(F.substring(s, 1, 20))), asc=False), 1, top)
    n = F.size(sites)
    mean = F.when(n > 0, F.round(F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) / F.size(scores), 3)).otherwise(0.0)
    risk = F.when(n > 50, "high").when(n > 15, "medium").otherwise("low")
    return F.when(F.length(seq) > 0, F.struct(n.alias("sites"), mean.alias("mean_efficiency"), risk.alias("risk")))


def boman_index(seq: Column) -> Column:
    """Mean residue potential, to four places."""
    table = literal_map(RESIDUE_POTENTIAL)
    total = F.aggregate(letters(F.upper(seq)), F.lit(0.0), lambda a, c: a + F.coalesce(F.try_element_at(table, c), F.lit(1.0)))
    return F.when(F.length(seq) > 0, F.round(total / F.length(seq), 4)).otherwise(0.0)


def half_life_minutes(boman: Column, length: Column) -> Column:
    return F.when(length >= 5, F.round(30.0 * (boman / 2.0) * (1.0 + (20 - F.least(length, F.lit(20))) / 20.0), 1))


def synthesisable(animal: Column, human: Column) -> Column:
    """10 to 20 residues without gaps, at most three cysteines."""
    seq = F.regexp_replace(F.coalesce(F.nullif(animal, F.lit("")), human, F.lit("")), "-", "")
    return F.length(seq).between(10, 20) & (F.length(seq) - F.length(F.translate(seq, "Cc", "")) <= 3)


def family_name(similarity: Column) -> Column:
    """Last segment of the first sentence of a family comment, without its lead-in."""
    first = F.split(similarity, "\\.")[0]
    return F.trim(F.element_at(F.split(F.regexp_replace(first, "(?i)^belongs to (the )?", ""), ","), -1))


def mark_foreground(newick: Column, species: list[str]) -> Column:
    """Drop labels of inner nodes and put #1 after the named leaves."""
    out = F.regexp_replace(newick, r"\)[^:,;()]+", ")")
    return reduce(lambda t, s: F.regexp_replace(t, rf"(?<=[(,])({s})(?=[:,)])", r"$1 #1"), species, out)


def any_term(text: Column, terms: list[str]) -> Column:
    """Whether the lower-cased text holds any of the terms."""
    return reduce(lambda a, b: a | b, [F.contains(F.lower(text), F.lit(t.lower())) for t in terms], F.lit(False))


def atom_docking_proxy(smiles: Column, pocket: Column) -> Column:
    """-5 times the pocket's score, less 0.1 for each of the letters C, N, O and S beyond 30."""
    atoms = F.length(smiles) - F.length(F.translate(smiles, "CNOS", ""))
    base = -5.0 * F.when(pocket.isNull() | (pocket == 0), 0.5).otherwise(pocket)
    return F.when(smiles.isNull() | (smiles == ""), -1.0).otherwise(F.round(base - F.greatest(F.lit(0.0), (atoms - 30) * 0.1), 2))


def tanimoto(a: Column, b: Column) -> Column:
    """Of two fingerprints as arrays of longs."""
    bits = lambda op: F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(op(x, y))), F.lit(0), lambda s, x: s + x)
    either = bits(lambda x, y: x.bitwiseOR(y))
    return F.when(either == 0, 0.0).otherwise(bits(lambda x, y: x.bitwiseAND(y)) / either)


def cosine_distance(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm == 0, F.lit(None).cast("double")).otherwise(1.0 - dot(a, b) / norm)


def protein_range(motif: Column, protein: Column) -> Column:
    """(start, end), 1-based, of a motif without its gaps in a protein; null where it isn't found."""
    bare = F.regexp_replace(motif, "-", "")
    at = F.instr(protein, bare)
    return F.when((F.length(bare) > 0) & (at > 0), F.struct(at.alias("start"), (at + F.length(bare) - 1).alias("end")))


def uuid5(name: Column, namespace: str) -> Column:
    """SQ27: the name-based identifier of a text in a namespace, as 8-4-4-4-12 digits."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    part = lambda start, n: F.substring(digest, start, n)
    variant = F.translate(part(17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(variant, part(18, 3)), part(21, 12))
