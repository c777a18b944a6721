"""Score formulas as column expressions over one row of each gene's tables.

r4 is rounding to four places, L(p) is -log10(p). A null input skips its term unless stated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Models whose p value counts as selection evidence come as a parameter; the weight that
# phylogenetic convergence is scaled by, and the named model with its own formula.
MAX_PHYLO_WEIGHT = 20.46
BRANCH_SITE = "paml_branch_site"


def r4(x: Column) -> Column:
    return F.round(x, 4)


def neg_log10(p: Column) -> Column:
    return -F.log10(p)


def capped(x: Column, top: float = 1.0) -> Column:
    """At most `top`; least() alone would take a null for the larger value."""
    return F.when(x.isNotNull(), F.least(x, F.lit(top)))


def _sum(*terms: Column) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(t, F.lit(0.0)) for t in terms])


def convergence(count: Column, weight: Column) -> Column:
    """DS1."""
    sigmoid = r4(1.0 / (1.0 + F.exp(-1.5 * (count - 2.0))))
    return F.when(weight > 0, r4(capped(weight / MAX_PHYLO_WEIGHT))).when(count.isNull() | (count <= 0), 0.0).otherwise(sigmoid)


def selection(model: Column, omega: Column, p: Column, fel: Column, busted: Column, relax_k: Column, relax_p: Column, branches: Column, test_species: Column) -> Column:
    """DS2. branches and test_species are arrays."""
    site = F.when(p.isNull() | (p >= 1) | omega.isNull() | (omega <= 1), 0.0).otherwise(0.70 * r4(capped(neg_log10(F.greatest(p, F.lit(1e-10))) / 10)) + 0.30 * r4(capped(omega / 5)))
    phenotype = F.when((p > 0) & (p <= 1), r4(capped(neg_log10(p) / 10)))
    relax = F.when((relax_k > 1) & (relax_p > 0), capped((relax_k - 1) / 2) * capped(neg_log10(relax_p) / 10))
    sites = _sum(0.35 * capped(fel / 10), F.when(busted > 0, 0.30 * capped(neg_log10(busted) / 10)), 0.25 * phenotype, 0.10 * relax)
    absent = fel.isNull() & busted.isNull() & relax_k.isNull()
    # p outside (0, 1]: a blend of omega and a saturated p, weighed by the share of branches under test
    share = F.when(F.size(branches) > 0, F.size(F.filter(branches, lambda b: F.array_contains(test_species, b))) / F.size(branches))
    legacy = 0.5 * F.coalesce(capped(omega / 5), F.lit(0.0)) + 0.5 * F.when(p <= 0, 1.0).otherwise(0.0)
    legacy = legacy * F.when((legacy > 0) & share.isNotNull(), 0.5 + 0.5 * share).otherwise(1.0)
    other = F.when((p <= 0) | (p > 1), r4(legacy)).when(absent, r4(0.65 * F.coalesce(phenotype, F.lit(0.0)))).otherwise(r4(sites))
    return F.when(model == BRANCH_SITE, site).otherwise(other)


def disease_id(x: Column) -> Column:
    """SC4: EFO_0000001 as EFO:0000001."""
    return F.upper(F.replace(x, F.lit("_"), F.lit(":")))


def disease(has_row: Column, association: Column, gwas_p: Column, loeuf: Column, pli: Column, drug_phase: Column, indications: Column, phenotype_ids: Column, variants: Column, variant_p: Column) -> Column:
    """DS3."""
    upper = lambda ids: F.transform(ids, disease_id)
    known = (F.size(indications) > 0) & (F.size(phenotype_ids) > 0)
    credit = F.when(known & ~F.arrays_overlap(upper(indications), upper(phenotype_ids)), 0.08).otherwise(0.20)
    constraint = F.when(loeuf.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - loeuf))).otherwise(capped(pli))
    total = _sum(
        0.30 * capped(association), F.when(gwas_p > 0, 0.20 * capped(neg_log10(gwas_p) / 15)), 0.15 * constraint,
        F.when(drug_phase > 0, capped(drug_phase / 4) * credit), F.when((variants >= 1) & (variant_p < 5e-8), 0.15),
    )
    return F.when(has_row, r4(capped(total))).otherwise(0.0)


def druggability(pockets: Column, top_pocket: Column, p2rank: Column, chembl: Column, drugs: Column, tier: Column, sm: Column, ab: Column, protac: Column, proximal: Column) -> Column:
    """DS4."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    total = _sum(
        F.when(pockets > 0, 0.10), 0.30 * capped(top_pocket), F.when(p2rank > 0, 0.10 * capped(p2rank)), F.when(F.length(chembl) > 0, 0.10), F.when(F.size(drugs) > 0, 0.05),
        F.when(tier == "A", 0.10).when(tier == "B", 0.05), F.when(yes(sm) | yes(ab) | yes(protac), 0.10), F.when(proximal, 0.15),
    )
    return r4(capped(total))


def _ladder(x: Column, steps: list[tuple[float, float]]) -> Column:
    """The penalty of the first bound that x exceeds."""
    out = None
    for bound, penalty in steps:
        out = F.when(x > bound, penalty) if out is None else out.when(x > bound, penalty)
    return out.otherwise(0.0)


def safety(has_row: Column, hub: Column, essential: Column, family: Column, depmap: Column, tissues: Column, max_tpm: Column, phewas: Column) -> Column:
    """DS5: 1 less penalties, at least 0; 0.5 without a row. phewas is a map of trait to value."""
    values = F.map_values(phewas)
    strong = F.size(F.filter(values, lambda v: v > 0.3))
    penalties = _sum(
        F.when(hub, 0.1), F.when(essential, 0.2), F.when(family > 100, 0.2), _ladder(depmap, [(0.7, 0.3), (0.5, 0.15), (0.3, 0.05)]),
        _ladder(tissues, [(40, 0.2), (25, 0.1), (15, 0.05)]), _ladder(max_tpm, [(1000, 0.15), (500, 0.08)]),
        F.when(strong >= 15, 0.20).when(strong >= 5, 0.10), F.when(F.array_max(values) > 0.7, 0.10),
    )
    return F.when(has_row, r4(F.greatest(F.lit(0.0), 1 - penalties))).otherwise(0.5)


def regulatory(max_score: Column, max_lineages: Column) -> Column:
    """DS6, over a gene's aggregated rows."""
    return F.coalesce(r4(capped(max_score + 0.05 * max_lineages)), F.lit(0.0))


def nucleotide_divergence(conservation: Column, divergent: Column, convergent: Column, promoter_phylo: Column) -> Column:
    """DS7."""
    total = _sum(
        0.40 * (1 - F.greatest(F.lit(0.0), F.least(F.lit(1.0), conservation))), 0.30 * capped(divergent / 10),
        F.when(promoter_phylo < 0, 0.20 * capped(-promoter_phylo / 3)), 0.10 * capped(convergent / 5),
    )
    return r4(capped(total))


def composite(scores: dict[str, Column], weights: dict[str, float], core: tuple[str, ...] = ("convergence", "selection")) -> Column:
    """DS8: mean over the weights of core scores and of others above 0."""
    used = [(F.coalesce(s, F.lit(0.0)), w, k in core) for k, w in weights.items() if w > 0 and (s := scores.get(k)) is not None]
    counts = lambda s, is_core: F.lit(True) if is_core else s > 0
    top = _sum(*[F.when(counts(s, c), s * w) for s, w, c in used])
    base = _sum(*[F.when(counts(s, c), F.lit(w)) for s, w, c in used])
    return F.when(base > 0, r4(top / base)).otherwise(0.0)


def human_genetics(gwas_p: Column, pli: Column, association: Column, variants: Column, variant_p: Column) -> Column:
    """DS9."""
    gwas = F.when((gwas_p > 0) & (gwas_p < 5e-8), capped(neg_log10(gwas_p) / 15, 0.5)).when((gwas_p > 0) & (gwas_p < 1e-5), 0.1)
    variant = F.when(variants >= 1, F.when(variant_p < 5e-8, 0.5).when(variant_p < 1e-5, 0.2).otherwise(0.1))
    return r4(capped(_sum(gwas, 0.3 * capped(pli), F.when(association > 0.3, 0.3 * capped(association)), variant)))


def tier(score: Column, genetics: Column, first: float = 0.70, second: float = 0.40) -> Column:
    """DS9."""
    base = F.when(score >= first, "Tier1").when(score >= second, "Tier2").otherwise("Tier3")
    return F.when((score >= second) & (genetics >= 0.3), "Validated").otherwise(base)


def rank_product_tier(q: Column, layers: Column) -> Column:
    """DS11: by false discovery rate; fewer than two active layers fall to Tier3."""
    return F.when(layers < 2, "Tier3").when(q < 0.05, "Tier1").when(q < 0.20, "Tier2").otherwise("Tier3")


def phylogenetic_weight(lineages: Column, distances: Column, default: float = 100.0) -> Column:
    """DS14: n log2(1 + mean pair distance / 100). distances is a map of "a|b" in both orders."""
    names = F.array_sort(F.filter(F.array_distinct(lineages), lambda x: x.isNotNull() & (x != "Primates")))
    n = F.size(names)
    pair = lambda a, b: F.when(a < b, F.coalesce(F.try_element_at(distances, F.concat_ws("|", a, b)), F.lit(default)))
    pairs = F.filter(F.flatten(F.transform(names, lambda a: F.transform(names, lambda b: pair(a, b)))), lambda x: x.isNotNull())
    mean = F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x) / F.size(pairs)
    return F.when(n < 2, 0.0).otherwise(n * F.log2(1 + mean / 100))


def variant_direction(am: Column, esm: Column, loeuf: Column) -> Column:
    """DS22."""
    harmful, unlikely = F.coalesce(am > 0.6, F.lit(False)), F.coalesce(esm < -2.0, F.lit(False))
    return F.when(harmful & unlikely, F.when(loeuf > 0.35, "loss_of_function").otherwise("functional_shift")).when(harmful, "gain_of_function").otherwise("neutral")


def structural_context(feature: Column, adjacent: Column, disordered: Column, distance: Column) -> Column:
    """DS23."""
    out = F.when(feature == "active_site", "active_site").when(feature.isin("binding_site", "metal_binding"), "binding_site").when(disordered, "disordered")
    return out.when(adjacent, "pocket_adjacent").when(distance < 15.0, "surface_near_pocket").otherwise("distal")


def pathogenicity_class(score: Column) -> Column:
    return F.when(score >= 0.564, "likely_pathogenic").when(score <= 0.340, "likely_benign").when(score.isNotNull(), "ambiguous")


def functional_evidence(scores: dict[str, Column], weights: dict[str, float]) -> Column:
    """DS24: weighted mean over the sources that are present; 0 without any."""
    top = _sum(*[F.lit(weights[k]) * s for k, s in scores.items()])
    base = _sum(*[F.when(s.isNotNull(), F.lit(weights[k])) for k, s in scores.items()])
    return F.when(base > 0, r4(top / base)).otherwise(0.0)


def gtex_score(tpm: Column) -> Column:
    """SC8: of an array of values."""
    mean = F.aggregate(tpm, F.lit(0.0), lambda a, x: a + x) / F.size(tpm)
    return F.when(F.size(tpm) > 0, gtex_level(mean))


def gtex_level(mean: Column) -> Column:
    """SC8: of a mean."""
    return capped(F.log2(1 + mean) / 10)


def essentiality(chronos: Column) -> Column:
    """SC9."""
    return 1.0 / (1.0 + F.exp(10.0 * (chronos + 0.5)))


def expression_call(log2fc: Column, padj: Column) -> Column:
    """DS25: 1 for a strong significant change, 0.5 for a significant one."""
    return F.when((padj < 0.05) & (F.abs(log2fc) > 1), 1.0).when(padj < 0.05, 0.5).otherwise(0.0)


def readiness_parts(t: str = "therapy", d: str = "target", s: str = "safety", a: str = "disease") -> dict[str, Column]:
    """DS31: sub-scores from four struct columns, null where a gene has no row."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    therapy, target, flags, note = (F.col(x) for x in (t, d, s, a))
    synthesis = F.when(therapy.isNull(), 0.3).otherwise(_sum(F.when(yes(therapy["aav_compatible"]), 0.5), F.when((therapy["gene_size_bp"] > 0) & (therapy["gene_size_bp"] < 4700), 0.3), F.when(therapy["crispr_sites"] > 3, 0.2)))
    label = F.coalesce(F.nullif(target["druggability_tier"], F.lit("")), F.lit("C"))
    base = F.when(label == "A", 1.0).when(label == "B", 0.7).when(label == "undruggable", 0.05).otherwise(0.4)
    deliver = F.when(target.isNull(), 0.1).otherwise(_sum(base, F.when(yes(target["tractability_sm"]), 0.1), F.when(yes(target["tractability_ab"]), 0.1), F.when(yes(target["tractability_protac"]), 0.05)))
    model = _sum(F.lit(0.2), F.when(F.length(note["mouse_ko_phenotype"]) > 0, 0.4), F.when(flags["depmap_score"].isNotNull(), 0.1), F.when(flags["depmap_score"] < 0.5, 0.3))
    drugs = F.size(F.coalesce(target["existing_drugs"], F.array().cast("array<string>")))
    assay = _sum(F.when(drugs > 0, capped(drugs * 0.15, 0.6)), F.when(note["known_drug_phase"] > 0, capped(note["known_drug_phase"] * 0.1, 0.4)))
    return {k: capped(F.round(v, 3)) for k, v in (("synthesis_score", synthesis), ("deliverability_score", deliver), ("model_score", model), ("assay_score", assay))}


def readiness_overall(synthesis: Column, deliverability: Column, model: Column, assay: Column) -> Column:
    return r4(0.25 * synthesis + 0.35 * deliverability + 0.25 * model + 0.15 * assay)


def readiness_tier(overall: Column) -> Column:
    return F.when(overall >= 0.70, "Ready").when(overall >= 0.40, "Needs Work").otherwise("Exploratory")


def readiness_notes(synthesis: Column, deliverability: Column, model: Column, assay: Column) -> Column:
    # Notes in their order.
    notes = ((synthesis, "gene delivery needs verification"), (deliverability, "target tractability low"), (model, "no preclinical model data"), (assay, "no validated assay chemistry"))
    return F.nullif(F.concat_ws("; ", *[F.when(s < 0.3, F.lit(n)) for s, n in notes]), F.lit(""))


def hit_score(docking: Column, purchasable: Column, known_similarity: Column) -> Column:
    """DS32; docking is normalised within the gene."""
    return r4(0.50 * docking + 0.30 * F.when(purchasable, 1.0).otherwise(0.4) + 0.20 * (1 - F.coalesce(known_similarity, F.lit(0.0))))


def hit_tier(score: Column) -> Column:
    return F.when(score >= 0.70, "A").when(score >= 0.45, "B").otherwise("C")


def compound_score(hit: Column, lipinski: Column, selectivity: Column, tox: Column, sa: Column) -> Column:
    """DS32. A selectivity or accessibility of 0 counts as unknown, 0.5."""
    known = lambda c: F.when(c.isNull() | (c == 0), 0.5).otherwise(c)
    return r4(0.30 * F.coalesce(hit, F.lit(0.0)) + 0.15 * F.when(lipinski, 1.0).otherwise(0.0) + 0.20 * known(selectivity) + 0.20 * (1 - F.coalesce(tox, F.lit(0.0))) + 0.15 * known(sa))


def compound_tier(score: Column) -> Column:
    return F.when(score >= 0.65, "Lead").when(score >= 0.40, "Hit").when(score >= 0.25, "Fragment").otherwise("Reject")


def aav_size(protein_length: Column) -> Column:
    """DS33: base pairs with the overhead."""
    return protein_length * 3 + 300


def stage_number(stage: Column) -> Column:
    """SC6: clinical stage as a number."""
    s = F.upper(stage)
    return F.when(s == "APPROVED", 4).when(s.rlike("^PHASE_([1-3]B?|4)$"), F.substring(s, 7, 1).try_cast("int")).otherwise(0)


def tractability(items: Column) -> Column:
    """SC6: flags of an array of (modality, value)."""
    have = lambda test: F.exists(items, lambda i: F.coalesce(i["value"], F.lit(False)) & test(F.lower(F.coalesce(i["modality"], F.lit("")))))
    small = lambda m: (m == "sm") | F.contains(m, F.lit("small"))
    anti = lambda m: ~small(m) & m.isin("ab", "antibody")
    degrade = lambda m: ~small(m) & ~anti(m) & ((m == "pr") | F.contains(m, F.lit("degrader")) | F.contains(m, F.lit("protac")))
    return F.struct(have(small).alias("sm"), have(anti).alias("ab"), have(degrade).alias("protac"))


def experiment_recommendations(context: dict[str, str], pocket: Column, drugs: Column, aav: Column) -> Column:
    """DS37: three first experiments. context has knockdown, repurposing (with {drug}), in_vivo, organoid, screening and assay."""
    before, _, after = context["repurposing"].partition("{drug}")
    repurposing = F.concat(F.lit(before), F.get(drugs, 0), F.lit(after))
    assay = F.when(pocket > 0.5, context["screening"]).when(F.size(drugs) > 0, repurposing).otherwise(context["assay"])
    return F.array(F.lit(context["knockdown"]), assay, F.when(aav, context["in_vivo"]).otherwise(context["organoid"]))
