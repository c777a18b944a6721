"""Validation gates and data-quality rules: metrics as one row, verdicts by thresholds."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Gate:
    """A metric with bounds: at least `good` passes, at least `fair` warns; with `low` the other way round."""

    name: str
    metric: str
    good: float
    fair: float | None = None
    low: bool = False

    def status(self) -> Column:
        value = F.col(self.metric)
        meets = lambda bound: value < bound if self.low else value >= bound
        out = F.when(meets(self.good), "PASS")
        return (out if self.fair is None else out.when(meets(self.fair), "WARN")).otherwise("FAIL")


def run_gates(metrics: DataFrame, step: str, gates: list[Gate]) -> DataFrame:
    """DS35, DS36: (step, name, status, value) from one row of metrics. A null metric fails."""
    rows = F.array(*[F.struct(F.lit(g.name).alias("name"), g.status().alias("status"), F.col(g.metric).cast("double").alias("value")) for g in gates])
    return metrics.select(F.explode(rows).alias("r")).select(F.lit(step).alias("step"), "r.*")


def fold_status(checks: DataFrame) -> DataFrame:
    """DS35: (step, status): FAIL over WARN over PASS; INFO changes nothing."""
    return checks.groupBy("step").agg(F.when(F.max((F.col("status") == "FAIL").cast("int")) == 1, "FAIL").when(F.max((F.col("status") == "WARN").cast("int")) == 1, "WARN").otherwise("PASS").alias("status"))


def percent(part: Column, whole: Column) -> Column:
    return F.round(100 * part / F.greatest(whole, F.lit(1)), 1)


# Thresholds of the rules.
ORTHOLOG_GATES = [Gate("gene coverage", "gene_coverage", 80), Gate("median species per gene", "median_species", 4, 3), Gate("low identity", "low_identity", 15, low=True), Gate("missing identity", "missing_identity", 5, float("inf"), low=True)]
MOTIF_GATES = [Gate("motifs", "motifs", 1), Gate("genes without motifs", "genes_without", 15, low=True)]


def ortholog_metrics(genes: DataFrame, orthologs: DataFrame, species: DataFrame) -> DataFrame:
    """AG7, AG9: coverage, species per gene without controls, identity."""
    controls = species.where("is_control").select(F.col("id").alias("species_id"))
    per = orthologs.join(F.broadcast(controls), "species_id", "left_anti").groupBy("gene_id").agg(F.countDistinct("species_id").alias("n"))
    one = genes.agg(F.count("*").alias("genes")).crossJoin(per.agg(F.percentile("n", 0.5).alias("median_species")))
    sums = orthologs.agg(F.countDistinct("gene_id").alias("covered"), F.count("*").alias("rows"), F.count_if(F.col("sequence_identity_pct") < 25).alias("low"), F.count_if(F.col("sequence_identity_pct").isNull()).alias("missing"))
    c = F.col
    return one.crossJoin(sums).select(percent(c("covered"), c("genes")).alias("gene_coverage"), F.round("median_species", 1).alias("median_species"), percent(c("low"), c("rows")).alias("low_identity"), percent(c("missing"), c("rows")).alias("missing_identity"))


def motif_metrics(genes: DataFrame, orthologs: DataFrame, motifs: DataFrame) -> DataFrame:
    """JN5: motifs, and the percent of genes without any."""
    having = motifs.select("ortholog_id").distinct().join(orthologs.select(F.col("id").alias("ortholog_id"), F.col("gene_id").alias("id")), "ortholog_id").select("id").distinct()
    without = genes.join(having, "id", "left_anti").agg(F.count("*").alias("without"))
    return genes.agg(F.count("*").alias("genes")).crossJoin(without).crossJoin(motifs.agg(F.count("*").alias("motifs"))).select("motifs", percent(F.col("without"), F.col("genes")).alias("genes_without"))


def orphans(rows: DataFrame, parents: DataFrame, key: str, parent_key: str = "id") -> DataFrame:
    """JN6, JN7: rows whose parent is gone."""
    return rows.join(parents.select(F.col(parent_key).alias(key)), key, "left_anti")


# --- the rules across tables -------------------------------------------------------------------

Measure = Callable[[], Column]


def _count(condition: str) -> Measure:
    return lambda: F.count_if(F.expr(condition))


def _sum(value: str, condition: str = "true") -> Measure:
    return lambda: F.sum(F.when(F.expr(condition), F.expr(value)))


#: By table, what its rules need and a single pass over its rows can count: a run observes these while it writes the table.
OBSERVED: dict[str, dict[str, Measure]] = {
    "ortholog_aligned": {"low": _count("sequence_identity_pct < 25"), "unknown": _count("sequence_identity_pct IS NULL")},
    "nucleotide_score": {
        "cds": _count("region_type = 'cds' AND percent_identity IS NOT NULL"), "identity": _sum("percent_identity", "region_type = 'cds'"),
        "cds_gaps": _count("region_type = 'cds' AND gap_fraction IS NOT NULL"), "gaps": _sum("gap_fraction", "region_type = 'cds'"),
    },
    "phylo_conservation_score": {"scored": _count("cds_phylo_score IS NOT NULL"), "implausible": _count("cds_phylo_score > 10")},
    "divergent_motif": {
        "zero": _count("divergence_score = 0"), "scored": _count("consequence_score IS NOT NULL"), "flat": _count("consequence_score BETWEEN 0.4 AND 0.6"), "with_domain": _count("domain_name IS NOT NULL"),
        "classified": _count("motif_direction IS NOT NULL"), "neutral": _count("motif_direction = 'neutral'"), "shift": _count("motif_direction = 'functional_shift'"),
        "gain": _count("motif_direction = 'gain_of_function' AND consequence_score IS NOT NULL"), "gain_score": _sum("consequence_score", "motif_direction = 'gain_of_function'"),
        "loss": _count("motif_direction = 'loss_of_function' AND esm1v_score IS NOT NULL"), "loss_score": _sum("esm1v_score", "motif_direction = 'loss_of_function'"), "convergent": _count("convergent_aa_count > 0"),
    },
    "expression_result": {"zero": _count("log2fc = 0"), "known": _count("log2fc IS NOT NULL")},
    "candidate_score": {
        "no_expression": _count("expression_score = 0"), "first_without": _count("tier = 'Tier1' AND convergence_score = 0 AND selection_score = 0"), "first_low": _count("tier = 'Tier1' AND composite_score < 0.10"),
    },
}
#: What needs the values side by side, or other tables; by table, with one aggregation each.
GATHERED: dict[str, dict[str, Measure]] = {
    "phylo_conservation_score": {"median": lambda: F.percentile("cds_phylo_score", 0.5)},
    "divergent_motif": {"median": lambda: F.percentile("divergence_score", 0.5)},
    "expression_result": {"genes": lambda: F.count_distinct("gene_id"), "conditions": lambda: F.count_distinct("comparison")},
    "candidate_score": {"spread": lambda: F.stddev("convergence_score"), "upper_genes": lambda: F.count_distinct(F.when(F.col("tier").isin("Tier1", "Tier2"), F.col("gene_id")))},
}
REGIONS = ("cds", "promoter", "downstream")


def _one_row(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), frames)  # of one row each


def quality_metrics(tables: dict[str, DataFrame], observed: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """One row of all metrics, named table__metric; null where a table is missing.

    observed has metrics by table as they were counted while it was written: what is there is not counted again.
    """
    observed, rows = observed or {}, []
    tables = {"ortholog_aligned": tables["ortholog"], **tables}
    spark = next(iter(tables.values())).sparkSession
    for name in dict.fromkeys((*OBSERVED, *GATHERED)):
        wanted = {"rows": lambda: F.count(F.lit(1)), **OBSERVED.get(name, {}), **GATHERED.get(name, {})}
        known = observed.get(name, {})
        todo = {k: m for k, m in wanted.items() if k not in known}
        if name not in tables:
            rows.append(spark.range(1).select(*[F.lit(None).cast("double").alias(f"{name}__{k}") for k in wanted]))
            continue
        if todo:
            rows.append(tables[name].agg(*[m().cast("double").alias(f"{name}__{k}") for k, m in todo.items()]))
        if len(todo) < len(wanted):
            rows.append(spark.range(1).select(*[F.lit(float(known[k])).alias(f"{name}__{k}") for k in wanted if k in known]))
    gene, ortholog = tables["gene"], tables["ortholog"]
    rows.append(gene.agg(F.count("*").cast("double").alias("gene__rows")))
    rows.append(ortholog.agg(F.count_distinct("gene_id").cast("double").alias("ortholog__genes")))
    controls = tables["species"].where("is_control").select(F.col("id").alias("species_id"))
    per = ortholog.join(controls, "species_id", "left_anti").groupBy("gene_id").agg(F.count_distinct("species_id").alias("n"))
    rows.append(per.agg(F.percentile("n", 0.5).alias("ortholog__median_species")))
    if "nucleotide_region" in tables:
        has = lambda kind: F.count_distinct(F.when((F.col("region_type") == kind) & (F.length("sequence") > 0), F.col("gene_id")))
        rows.append(tables["nucleotide_region"].agg(*[has(k).cast("double").alias(f"nucleotide_region__{k}") for k in REGIONS]))
    else:
        rows.append(spark.range(1).select(*[F.lit(None).cast("double").alias(f"nucleotide_region__{k}") for k in REGIONS]))
    none = lambda *names: spark.range(1).select(*[F.lit(None).cast("double").alias(n) for n in names])
    if "divergent_motif" in tables:
        owner = ortholog.select(F.col("id").alias("ortholog_id"), "gene_id")
        by_gene = tables["divergent_motif"].join(owner, "ortholog_id").groupBy("gene_id").agg(F.count_if(F.col("convergent_aa_count") > 2).alias("high"), F.count_if(~F.coalesce(F.col("convergent_aa_count") > 2, F.lit(False))).alias("low"))
        rows.append(gene.select(F.col("id").alias("gene_id")).join(by_gene, "gene_id", "left_anti").agg(F.count("*").cast("double").alias("gene__without_motif")))
        if "evolution_score" in tables:
            weighed = by_gene.join(tables["evolution_score"].where("convergence_pval IS NOT NULL").select("gene_id", "convergence_pval"), "gene_id")
            mean = lambda n: (F.sum(F.col("convergence_pval") * F.col(n)) / F.nullif(F.sum(n), F.lit(0))).alias(f"evolution_score__p_{n}")
            rows.append(weighed.agg(mean("high"), mean("low")))
        else:
            rows.append(none("evolution_score__p_high", "evolution_score__p_low"))
    else:
        rows.append(none("gene__without_motif", "evolution_score__p_high", "evolution_score__p_low"))
    if {"candidate_score", "evolution_score"} <= set(tables):
        rows.append(orphans(tables["candidate_score"], tables["evolution_score"], "gene_id", "gene_id").agg(F.count("*").cast("double").alias("candidate_score__orphans")))
    else:
        rows.append(none("candidate_score__orphans"))
    return _one_row(rows)


@dataclass(frozen=True)
class Rule:
    """A value of the metrics and what it has to meet, as SQL; `fair` only warns. Without a value a rule fails, or is left out if `optional`."""

    step: str
    name: str
    value: str
    good: str
    fair: str | None = None
    optional: bool = False

    def verdict(self) -> Column:
        v = F.expr(self.value).cast("double")
        holds = lambda test: F.coalesce(F.expr(test.format(v=f"({self.value})")), F.lit(False))
        out = F.when(holds(self.good), "PASS")
        out = out if self.fair is None else out.when(holds(self.fair), "WARN")
        return F.when(v.isNotNull() | F.lit(not self.optional), F.struct(F.lit(self.step).alias("step"), F.lit(self.name).alias("name"), out.otherwise("FAIL").alias("status"), F.round(v, 4).alias("value")))


def _percent(part: str, whole: str) -> str:
    return f"round(100 * coalesce({part}, 0) / greatest({whole}, 1), 1)"


_M = "divergent_motif__"
# The rules' bounds.
RULES = (
    Rule("step3b", "gene coverage", _percent("ortholog__genes", "gene__rows"), "{v} >= 80"),
    Rule("step3b", "median species per gene", "round(coalesce(ortholog__median_species, 0), 1)", "{v} >= 4", "{v} >= 3"),
    Rule("step3b", "low identity", _percent("ortholog_aligned__low", "ortholog_aligned__rows"), "{v} < 15"),
    Rule("step3b", "missing identity", _percent("ortholog_aligned__unknown", "ortholog_aligned__rows"), "{v} < 5", "true"),
    *[Rule("step3c", f"{k} coverage", _percent(f"nucleotide_region__{k}", "gene__rows"), "{v} >= " + ("70" if k == "cds" else "50")) for k in REGIONS],
    Rule("step3c", "cds identity", "round(nucleotide_score__identity / nullif(nucleotide_score__cds, 0), 1)", "{v} >= 40 AND round(nucleotide_score__gaps / nullif(nucleotide_score__cds_gaps, 0), 3) < 0.30"),
    Rule("step3d", "cds conservation coverage", _percent("phylo_conservation_score__scored", "phylo_conservation_score__rows"), "{v} >= 60"),
    Rule("step3d", "cds conservation", "round(phylo_conservation_score__median, 3)", "{v} > 0 AND phylo_conservation_score__implausible = 0"),
    Rule("step4", "motifs", f"{_M}rows", "{v} > 0"),
    Rule("step4", "genes without motifs", _percent("gene__without_motif", "gene__rows"), "{v} < 15"),
    Rule("step4", "divergence", f"round({_M}median, 3)", f"{{v}} BETWEEN 0.10 AND 0.65 AND {_percent(_M + 'zero', _M + 'rows')} < 5"),
    Rule("step4b", "pathogenicity coverage", _percent(f"{_M}scored", f"{_M}rows"), "{v} >= 50"),
    Rule("step4b", "pathogenicity spread", _percent(f"{_M}flat", f"{_M}scored"), "{v} < 30"),
    Rule("step4b", "domain coverage", f"round(100 * {_M}with_domain / nullif({_M}rows, 0), 1)", "{v} > 0"),
    Rule("step4d", "direction coverage", _percent(f"{_M}classified", f"{_M}rows"), "{v} >= 80"),
    Rule("step4d", "neutral share", f"coalesce(round(100 * {_M}neutral / nullif({_M}classified, 0), 1), 0)", "{v} <= 88"),
    Rule("step4d", "functional shift", f"{_M}shift", "{v} > 0"),
    Rule("step4d", "gain of function", f"{_M}gain_score / nullif({_M}gain, 0)", "{v} > 0.55", optional=True),
    Rule("step4d", "loss of function", f"{_M}loss_score / nullif({_M}loss, 0)", "{v} < -1.0", optional=True),
    Rule("step7b", "convergent residues", f"{_M}convergent", "{v} > 0"),
    Rule("step7b", "convergent motifs in significant genes", "round(coalesce(evolution_score__p_high, 1), 4)", "{v} <= round(coalesce(evolution_score__p_low, 1), 4)"),
    Rule("step8", "expression coverage", _percent("expression_result__genes", "candidate_score__upper_genes"), "{v} >= 80"),
    Rule("step8", "expression changes", "CASE WHEN expression_result__known > 0 THEN " + _percent("expression_result__zero", "expression_result__rows") + " END", "{v} < 30"),
    Rule("step8", "conditions", "coalesce(expression_result__conditions, 0)", "{v} >= 3"),
    # a share of 0 counts as unknown, 100, as in the original rule
    Rule("step8", "candidates without expression", "coalesce(nullif(round(100 * candidate_score__no_expression / nullif(candidate_score__rows, 0), 1), 0), 100)", "{v} < 50"),
    Rule("integrity", "orphan candidates", "coalesce(candidate_score__orphans, 0)", "{v} = 0"),
    Rule("integrity", "first tier without evidence", "coalesce(candidate_score__first_without, 0)", "{v} = 0"),
    Rule("integrity", "spread of convergence", "round(coalesce(candidate_score__spread, 0), 4)", "{v} > 0.05"),
    Rule("integrity", "first tier with low scores", "coalesce(candidate_score__first_low, 0)", "{v} = 0"),
)


def judged(metrics: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """DS36: (step, name, status, value) of one row of metrics."""
    found = F.filter(F.array(*[r.verdict() for r in rules]), lambda v: v.isNotNull())
    return metrics.select(F.explode(found).alias("r")).select("r.*")


def quality_report(tables: dict[str, DataFrame], observed: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """DS36, DS35: the verdicts of all rules, and a row for each step ("all rules") with the worst of them."""
    rows = judged(quality_metrics(tables, observed))
    return rows.unionByName(fold_status(rows).select("step", F.lit("all rules").alias("name"), "status", F.lit(None).cast("double").alias("value")))
