"""Sequence scalars against plain Python."""

import re

import pytest
from pyspark.sql import functions as F

from helixframe.functions import sequence as Q


def one(spark, row, ddl, expr):
    return spark.createDataFrame([row], ddl).select(expr.alias("x")).first().x


@pytest.mark.parametrize(("a", "b", "want"), [("ACDE", "ACDE", 0.0), ("ACDE", "WWWW", 1.0), ("AC-E", "ACD-", 0.5), ("----", "----", 0.0), ("ACD", "ACDE", 0.0), ("A--E", "A--W", 0.5)])
def test_window_divergence(spark, a, b, want):
    assert one(spark, (a, b), "a string, b string", Q.window_divergence(F.col("a"), F.col("b"))) == want


@pytest.mark.parametrize(("a", "b", "want"), [("ACDE", "ACDE", 100.0), ("ACDE", "WWWW", 0.0), ("ACDE", "ACWW", 50.0), ("A-DE", "A-DW", 200 / 3), ("--", "--", 0.0)])
def test_identity(spark, a, b, want):
    assert one(spark, (a, b), "a string, b string", Q.identity_percent(F.col("a"), F.col("b"))) == pytest.approx(want)


def test_identity_raises_for_unequal_lengths(spark):
    with pytest.raises(Exception, match="differ in length"):
        one(spark, ("ACD", "AC"), "a string, b string", Q.identity_percent(F.col("a"), F.col("b")))


def test_kmer_identity(spark):
    a, b = "MKTAYIAKQR" * 5, "MKTAYIWWQR" * 5
    x, y = ({s[i : i + 3] for i in range(len(s) - 2)} for s in (a, b))
    assert one(spark, (a, b), "a string, b string", Q.kmer_identity(F.col("a"), F.col("b"))) == pytest.approx(100 * len(x & y) / len(x | y))
    assert one(spark, ("AB-CDEFGH", "ABCDEFGHI"), "a string, b string", Q.kmer_identity(F.col("a"), F.col("b"))) == pytest.approx(40.0)  # gaps count
    assert one(spark, ("AC", "AD"), "a string, b string", Q.kmer_identity(F.col("a"), F.col("b"))) == 50.0
    assert one(spark, ("", ""), "a string, b string", Q.kmer_identity(F.col("a"), F.col("b"))) == 0.0


def test_labels_and_names(spark):
    rows = [("human|P1|x", "TP53_HUMAN", "sp|P04637|P53_HUMAN"), ("plain", "BRCA1", "P04637.2"), ("a|b", "x_MOUSE", "nothing")]
    df = spark.createDataFrame(rows, "label string, name string, raw string")
    got = df.select(Q.label_species(F.col("label")), Q.label_protein(F.col("label")), Q.symbol_before_underscore(F.col("name")), Q.symbol_without_species(F.col("name")), Q.accession(F.col("raw"))).collect()
    assert [tuple(r) for r in got] == [("human", "P1|x", "TP53", "TP53", "P04637"), ("plain", "plain", "BRCA1", "BRCA1", "P04637"), ("a", "b", "x", "x", None)]


def test_hgvs_and_classes(spark):
    df = spark.createDataFrame([("x:p.Ala123Val", "A", "V"), ("p.Xaa1Val", "K", "D"), (None, "F", None)], "h string, a string, b string")
    got = df.select(Q.hgvs_protein(F.col("h")).alias("h"), Q.similar_amino_acids(F.col("a"), F.col("b")).alias("s")).collect()
    assert tuple(got[0].h) == ("A", 123, "V") and got[0].s and got[1].h is None and not got[1].s and got[2].h is None and not got[2].s


def guide_score(g):
    gc = (g.count("G") + g.count("C")) / 20
    return round(min(1.0, 0.4 * (0.4 <= gc <= 0.7) + 0.2 * ("T" not in g[16:20]) + 0.2 * ("TTTT" not in g) + 0.1 * (g[19] in "AG") + 0.1 * (g[0] != "G")), 3)


def test_guides(spark):
    seq = "ACGTTGCAAGGCTTACGGATCCGGTTTTACGAGGCATGGCCAGGTACCGGTTAACGGCATCGGA" * 3
    sites = re.findall("(?=([ACGT]{20}GG))", seq)
    got = one(spark, (seq,), "s string", Q.scored_guides(F.col("s")))
    scores = sorted((guide_score(s[:20]) for s in sites), reverse=True)[:50]
    assert got.sites == len(sites) and got.mean_efficiency == pytest.approx(sum(scores) / len(scores), abs=6e-4)
    assert got.risk == ("high" if len(sites) > 50 else "medium" if len(sites) > 15 else "low")
    assert one(spark, (seq,), "s string", Q.pam_sites(F.col("s"))) == len(sites)
    assert one(spark, ("A" * 10001,), "s string", Q.pam_sites(F.col("s"))) == 0


def test_peptides(spark):
    got = spark.createDataFrame([("ACDEFGHIKL", ""), ("CCCC-AAAAAAAA", "x"), ("", "ACDEFGHIKLMN")], "a string, h string").select(
        Q.boman_index(F.col("a")).alias("b"), Q.half_life_minutes(Q.boman_index(F.col("a")), F.length("a")).alias("t"), Q.synthesisable(F.col("a"), F.col("h")).alias("s")
    ).collect()
    mean = sum(Q.RESIDUE_POTENTIAL[c] for c in "ACDEFGHIKL") / 10
    assert got[0].b == pytest.approx(mean, abs=1e-4) and got[0].s and not got[1].s and got[2].s and got[2].t is None


def test_fingerprints_and_ranges(spark):
    assert one(spark, ([0b1100], [0b0110]), "a array<long>, b array<long>", Q.tanimoto(F.col("a"), F.col("b"))) == pytest.approx(1 / 3)
    assert tuple(one(spark, ("C-D", "ABCDE"), "a string, b string", Q.protein_range(F.col("a"), F.col("b")))) == (3, 4)
    assert one(spark, ("ZZ", "ABCDE"), "a string, b string", Q.protein_range(F.col("a"), F.col("b"))) is None
    assert one(spark, ("CCNO" * 10, 0.8), "a string, p double", Q.atom_docking_proxy(F.col("a"), F.col("p"))) == -5.0
    assert one(spark, ("((a:1,b:2)x:3,c:1);",), "t string", Q.mark_foreground(F.col("t"), ["b"])) == "((a:1,b #1:2):3,c:1);"


def test_uuid5(spark):
    import uuid

    for name in ("P04637", "naïve", ""):
        assert one(spark, (name,), "n string", Q.uuid5(F.col("n"), str(uuid.NAMESPACE_DNS))) == str(uuid.uuid5(uuid.NAMESPACE_DNS, name))
