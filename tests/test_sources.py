"""Readers and sinks on small files."""

import json

import pytest
from pyspark.sql import functions as F

from helixframe.operators import relational as R
from helixframe.sources import genome, readers, sinks


def put(folder, name, text):
    (folder / name).write_text(text)
    return str(folder / name)


def test_fasta(spark, tmp_path):
    path = put(tmp_path, "human.reheadered.faa", ">sp|P12345|X_HUMAN some text\nMKT\nAYI\n>NP_1.2 other\nACDE\n>a|b\nWW\n")
    fasta = readers.read_fasta(spark, path)
    assert {(r.id, r.sequence) for r in fasta.collect()} == {("sp|P12345|X_HUMAN", "MKTAYI"), ("NP_1.2", "ACDE"), ("a|b", "WW")}
    assert {r.id for r in readers.reheadered(fasta, "human").collect()} == {"human|P12345", "human|NP_1.2", "human|b"}
    assert readers.valid_proteomes(fasta, 3).first().valid and readers.sequence_map(fasta).first().species_id == "human"
    back = tmp_path / "out"
    sinks.fasta_lines(fasta, "id", "sequence").coalesce(1).write.text(str(back))
    assert readers.read_fasta(spark, str(back)).select("id", "sequence").exceptAll(fasta.select("id", "sequence")).count() == 0


def test_empty_fasta(spark, tmp_path):
    assert readers.read_fasta(spark, put(tmp_path, "e.faa", "")).count() == 0


def test_registry(spark, tmp_path):
    rows = [{"id": "human", "phenotypes": ["baseline"], "is_control": False}, {"id": "nmr", "phenotypes": ["longevity"], "is_control": False}, {"id": "rat", "phenotypes": [], "is_control": True}, {"id": "bat", "phenotypes": ["flight"], "is_control": None}]
    registry = readers.read_registry(spark, put(tmp_path, "r.json", json.dumps(rows)), "longevity")
    assert {r.id for r in registry.collect()} == {"human", "nmr", "rat"}
    known = registry.where("id = 'human'")
    assert readers.seed_species(known, registry).count() == 3


def test_orthogroups(spark, tmp_path):
    path = put(tmp_path, "o.tsv", "Orthogroup\thuman.reheadered\tbat.reheadered\tbat\nOG1\tP1, P2\tB1\tzz\nOG2\t\tB2\tzz\nOG3\tP3\t\tzz\n")
    got = {(r.og_id, r.species_id, r.protein_id, r.place) for r in readers.read_orthogroups(spark, path).collect()}
    assert got == {("OG1", "human", "P1", 0), ("OG1", "human", "P2", 1), ("OG1", "bat", "B1", 0), ("OG3", "human", "P3", 0)}


def test_gff_and_regions(spark, tmp_path):
    lines = [
        "##gff", "c1\tx\tgene\t101\t200\t.\t+\t.\tID=gene-A;Name=A;Dbxref=GeneID:7,X:1", "c1\tx\tCDS\t120\t130\t.\t+\t0\tprotein_id=NP_1.2", "c1\tx\tCDS\t150\t180\t.\t+\t0\tprotein_id=NP_1.2",
        "c1\tx\tmRNA\t105\t200\t.\t-\t.\tName=A", "c1\tx\tgene\tbad\t200\t.\t+\t.\tName=B", "short\tline",
    ]
    index = readers.gene_index(readers.read_gff3(spark, put(tmp_path, "g.gff", "\n".join(lines))))
    of = {r.key: (r.start, r.end, r.strand, r.tss) for r in index.collect()}
    assert of["NP_1.2"] == of["NP_1"] == (120, 180, "+", 120) and of["A"] == (105, 200, "-", 200) and of["GENEID:7"] == (101, 200, "+", 101) and "B" not in of
    genes = spark.createDataFrame([("g1", "bat", "A_HUMAN", "bat|NP_1.2"), ("g2", "bat", "A_HUMAN", "bat|zz"), ("g3", "bat", "none", "zz")], "gene_id string, species_id string, gene_symbol string, protein_id string")
    located = readers.gene_coordinates(genes, index)
    assert {r.gene_id: r.start for r in located.collect()} == {"g1": 120, "g2": 105}
    contig = "ACGTTGCAGG" * 24
    blocks = genome.blocks_of(spark.createDataFrame([("bat", "c1", contig)], "species_id string, chrom string, sequence string"), 32)
    regions = {(r.gene_id, r.region_type): r for r in genome.regions(located, blocks, 50, 10, 32).collect()}
    assert regions["g1", "promoter"].start == 70 and regions["g1", "promoter"].sequence == contig[69:119]
    assert regions["g1", "cds"].sequence == contig[119:180] and regions["g2", "promoter"].start == 201 and regions["g2", "promoter"].sequence == contig[200:240]


def test_windows_over_borders_and_ends(spark):
    contig = "".join("ACGT"[i * i % 7 % 4] for i in range(100))
    blocks = genome.blocks_of(spark.createDataFrame([("a", "c", contig), ("a", "d", "TT"), ("b", "c", ""), ("b", "e", None)], "species_id string, chrom string, sequence string"), 16)
    assert {r["bases"] for r in blocks.where("chrom = 'd'").collect()} == {"TT"} and blocks.where("species_id = 'b'").count() == 0
    spans = [(1, 100), (16, 17), (17, 32), (-5, 3), (0, 0), (99, 400), (101, 200), (50, 49), (33, 33), (1, 16)]
    windows = spark.createDataFrame([("a", "c", a, b) for a, b in spans + spans[:2]] + [("a", "none", 1, 5), ("b", "c", 1, 5), ("a", "d", 1, 9)], "species_id string, chrom string, start int, end int")
    got = {(r.chrom, r.start, r.end): r.sequence for r in genome.cut_windows(windows, blocks, 16).collect()}
    want = {("c", a, b): contig[max(a, 1) - 1 : max(b, 0)] for a, b in spans}
    assert got == {k: v for k, v in want.items() if v} | {("d", 1, 9): "TT"}


@pytest.mark.parametrize("split", ["40b", "64m"])
def test_genome_in_blocks_however_it_is_split(spark, tmp_path, split):
    """Contigs go on over splits; headers have comments; the last of two contigs with one id counts; lines may be empty."""
    text = ">c1 first\nACGTAC\nGTTTGACCA\n\n" + "GATTACA\r\n" * 30 + ">empty\n>c2\n" + "A" * 70 + "\n>c3\nacgtn\n>c2 again\n" + "CCGG\n" * 9 + ">c4\nT"
    (tmp_path / "g").mkdir()
    put(tmp_path / "g", "a.fa", text)
    put(tmp_path / "g", "b.fa", ">d1\nGG\nTT\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = genome.read_genome(spark, str(tmp_path / "g"), "bat", 16).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {"c1": "ACGTACGTTTGACCA" + "GATTACA" * 30, "c2": "CCGG" * 9, "c3": "acgtn", "c4": "T", "d1": "GGTT"}
    assert {(r.chrom, r.block): r.bases for r in got} == {(c, i // 16): s[i : i + 16] for c, s in want.items() for i in range(0, len(s), 16)}
    genome.write_genome(spark.createDataFrame(got), str(tmp_path / "blocks"))
    assert spark.read.parquet(str(tmp_path / "blocks")).count() == len(got)


def test_score_tables(spark, tmp_path):
    gnomad = put(tmp_path, "c.tsv", "gene\tcanonical\tlof.oe_ci.upper\nA\ttrue\t0.5\nA\ttrue\t0.4\nB\tfalse\t0.1\nC\ttrue\tNA\n")
    assert [tuple(r) for r in readers.read_constraint(spark, gnomad).collect()] == [("A", 0.4)]
    am = put(tmp_path, "am.tsv", "#c\nx\tx\tx\tx\tx\tp1\tt\tA12V\t0.9\tz\nx\tx\tx\tx\tx\tP2\tt\tA1V\t0.1\tz\nx\tx\tx\tx\tx\tP1\tt\tbad\t0.1\tz\n")
    only = spark.createDataFrame([("P1",)], "accession string")
    assert [tuple(r) for r in readers.read_pathogenicity(spark, am, only).collect()] == [("P1", 12, "V", 0.9)]
    dep = put(tmp_path, "d.csv", "line,TP53 (7157),A (1)\nx,-0.5,\ny,-1.0,\n")
    assert [tuple(r) for r in readers.read_dependency_matrix(spark, dep).collect()] == [("TP53", -0.75)]
    paf = put(tmp_path, "a.paf", "q\t1\t2\t3\t+\tt\t1\t2\t3\t80\t100\t60\tcg:Z:50M5I3D\nq\t1\t2\t3\t+\tt\t1\t2\t3\t99\t100\t60\nbad\n")
    r = readers.read_paf(spark, paf).first()
    assert (r.percent_identity, r.alignment_length, r.gap_fraction) == (80.0, 100, 0.08)


def test_structures(spark, tmp_path):
    atom = "ATOM      2  CA  ALA A  12      11.104   6.134  -6.504  1.00 85.50           C"
    r = readers.read_pdb_ca(spark, put(tmp_path, "p.pdb", atom + "\n" + atom.replace(" CA ", " CB ") + "\nEND\n")).first()
    assert (r.residue, r.x, r.y, r.z, r.plddt) == (12, 11.104, 6.134, -6.504, 85.5)
    pockets = readers.read_pockets(spark, put(tmp_path, "p.csv", "name, rank, score, probability\npocket1 , 1, 9.5, 0.8\npocket2, 2, , x\n")).orderBy("rank").collect()
    assert [(p.rank, p.score, p.probability) for p in pockets] == [(1, 9.5, 0.8), (2, 0.0, 0.0)]


def test_selection_outputs(spark, tmp_path):
    text = "lnL(ntime: 10  np: 15):  -1234.5 +0.0\nbackground w  0.1 1.0 0.1 1.0\nforeground w  0.1 1.0 0.1 999.0\n"
    r = readers.read_codeml(spark, put(tmp_path, "m.txt", text)).first()
    assert (r.lnl, r.omega_foreground, r.omega_background) == (-1234.5, 99.0, 0.1)
    wig = put(tmp_path, "w.wig", "fixedStep chrom=a start=1\n1.0\n2.0\n\n# x\n500\n7 3.0\n")
    assert readers.read_wig_means(spark, wig).first()["mean"] == 2.0
    meme = put(tmp_path, "meme.json", json.dumps({"MLE": {"content": {"0": [[1, 0, 0, 5.0, 0, 0.01], [1, 0, 0, 1.0, 0, 0.5], [1, 0, 0, 10.0, 0, 0.04], [1, 0, 0, 0, 0, None]]}}}))
    m = readers.read_meme(spark, meme).first()
    assert m.omega == pytest.approx(0.5 * 1.5) and m.p == pytest.approx((0.01 * 0.04) ** 0.5)
    fel = put(tmp_path, "fel.json", json.dumps({"MLE": {"headers": [["alpha", "x"], ["beta", "x"], ["alpha=beta", "x"], ["LRT", "x"], ["p-value", "x"]], "content": {"0": [[1, 2, 0, 0, 0.01], [2, 1, 0, 0, 0.01]]}}}))
    assert readers.read_fel(spark, fel).first().fel_sites == 2  # the header "alpha=beta" holds "alpha" and comes last
    fubar = put(tmp_path, "fub.json", json.dumps({"MLE": {"content": {"0": [[0, 0, 0, 0.95, 0.1], [0, 0, 0, 0.2, 0.99], [0, 0]]}}}))
    assert tuple(readers.read_fubar(spark, fubar).first())[1:] == (1, 1)
    relax = put(tmp_path, "relax.json", json.dumps({"test results": {"p-value": 0.03, "relaxation or intensification parameter": 1.5}}))
    assert tuple(readers.read_test_results(spark, relax).first())[1:] == (0.03, 1.5)
    absrel = put(tmp_path, "ab.json", json.dumps({"branch attributes": {"0": {"s1": {"Corrected P-value": 0.01, "Rate Distributions": [[3.0, 1.0]]}, "s2": {"Corrected P-value": 0.9, "Rate Distributions": [[9.0, 1.0]]}}}}))
    a = readers.read_absrel(spark, absrel).first()
    assert (a.omega, a.p, a.branches) == (3.0, 0.01, ["s1"])


def test_keyed_updates(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id long, s string, v double")
    new = spark.createDataFrame([(2, None, 9.0), (3, "c", 3.0)], "id long, s string, v double")
    as_map = lambda df: {r.id: (r.s, r.v) for r in df.collect()}
    assert as_map(R.upsert(old, new, ["id"])) == {1: ("a", 1.0), 2: ("b", 9.0), 3: ("c", 3.0)}
    assert as_map(R.update_columns(old, new, ["id"])) == {1: ("a", 1.0), 2: ("b", 9.0)}
    assert as_map(R.replace_keys(old, new, ["id"])) == {1: ("a", 1.0), 2: (None, 9.0), 3: ("c", 3.0)}
    assert as_map(R.insert_missing(old, new, ["id"])) == {1: ("a", 1.0), 2: ("b", 2.0), 3: ("c", 3.0)}
    arrays = spark.createDataFrame([([1, 2], [7.0, None])], "id array<long>, v array<double>")
    assert as_map(R.update_from_arrays(old, "id", arrays)) == {1: ("a", 7.0), 2: ("b", 2.0)}
    with pytest.raises(ValueError, match="duplicate"):
        R.assert_unique(old.union(old), ["id"])


def test_alignments_and_dossiers(spark):
    rows = spark.createDataFrame([("g", "a", "ACG"), ("g", "b", "A")], "g string, n string, s string")
    assert {r.s for r in sinks.padded_msa(rows, "g", "n", "s").collect()} == {"ACG", "A--"}
    assert sinks.phylip(rows, "g", "n", "s").first().value.startswith(" 2 3\na")
    genes = spark.createDataFrame([("1", "TP53", "text", None)], "gene_id string, gene_symbol string, why string, none string")
    assert sinks.dossiers(genes, {"Why": "why", "None": "none"}).first().markdown == "# TP53\n## Why\ntext\n"
    table = [("Liver", "AAV8"), ("Heart", "AAV9"), ("Brain", "AAV9")]
    t = spark.createDataFrame([({"Liver_x": 5.0, "Heart": 9.0, "Brain": 7.0, "Skin": 1.0},)], "m map<string,double>")
    assert t.select(sinks.tissue_serotypes(F.col("m"), table).alias("s")).first().s == ["AAV9", "AAV8"]


def test_residues_over_9999(spark, tmp_path):
    from helixframe.plans import landing

    keys = [1, 9_998, 9_999, 10_001, 59_999, 100_001, 359_999, 1_223_055, 1_223_057, 2_436_111]
    spark.createDataFrame([(k, 12.34, 3) for k in keys], "s_suppkey long, s_acctbal double, s_nationkey int").write.parquet(str(tmp_path / "supplier.parquet"))
    rows = landing.structure_atoms(spark, str(tmp_path)).collect()
    assert sorted(r.residue for r in rows) == [k for k in keys if k % 4] and {(r.x, r.y, r.plddt) for r in rows} == {(1.234, 0.375, 50.25)}
    coded = spark.createDataFrame([(9_999,), (10_000,), (1_223_055,), (1_223_056,)], "n long").select(readers.hybrid_36(F.col("n"), 4).alias("c"))
    assert [r.c for r in coded.collect()] == ["9999", "A000", "ZZZZ", "a000"]
