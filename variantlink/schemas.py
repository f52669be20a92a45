"""Declared schemas of inputs and outputs.

Column names and types are fixed values: they are the tables' contract.
"""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, LongType, StringType, StructField, StructType

_KINDS: dict[str, DataType] = {"string": StringType(), "long": LongType(), "double": DoubleType(), "boolean": BooleanType()}
_KINDS |= {f"array<{k}>": ArrayType(v) for k, v in [*_KINDS.items()]}


def struct(columns: str, **nested: DataType) -> StructType:
    """``name kind, …`` as a schema, without a session; ``nested`` columns come last."""
    pairs = [x.split() for x in columns.split(",")]
    return StructType([StructField(n, _KINDS[k]) for n, k in pairs] + [StructField(n, t) for n, t in nested.items()])


VARIANT_KEY = ["chr_id", "position", "ref_allele", "alt_allele"]
LEAD_KEY = ["study_id", "lead_chrom", "lead_pos", "lead_ref", "lead_alt"]
TAG_KEY = ["tag_chrom", "tag_pos", "tag_ref", "tag_alt"]
LOCUS_KEY = ["study", "chrom", "pos", "ref", "alt"]

#: Gene groups by biotype, chromosomes, weights and limits.
PROTEIN_CODING = ["protein_coding"]
APPROVED_BIOTYPES = [
    "3prime_overlapping_ncRNA",
    "antisense",
    "bidirectional_promoter_lncRNA",
    "IG_C_gene",
    "IG_D_gene",
    "IG_J_gene",
    "IG_V_gene",
    "lincRNA",
    "macro_lncRNA",
    "non_coding",
    "protein_coding",
    "sense_intronic",
    "sense_overlapping",
]
CHROMOSOMES = [*map(str, range(1, 23)), "X", "Y", "MT"]

#: Default weight of each evidence source.
SOURCE_WEIGHTS = {
    "vep": 1.0,
    "eqtl": 0.66,
    "pqtl": 0.66,
    "sqtl": 1.0,
    "jung2019": 0.33,
    "javierre2016": 0.33,
    "andersson2014": 0.33,
    "thurman2012": 0.33,
    "canonical_tss": 0.33,
}
NEAREST_MAX_DISTANCE, EVIDENCE_MAX_DISTANCE = 5_000_000, 500_000
MIN_PROBABILITY, MIN_COLOC_H4, MIN_COLOC_RATIO = 0.5, 0.95, 5

GENES = struct(
    "chr string, gene_id string, gene_name string, description string, fwdstrand boolean, exons array<long>, "
    "tss long, start long, end long, biotype string"
)
CONSEQUENCE_SCORES = struct(
    "accession string, term string, description string, display_term string, impact string, v2g_score double, eco_score double"
)
FREQUENCIES = [
    "gnomad_afr", "gnomad_amr", "gnomad_asj", "gnomad_eas", "gnomad_fin", "gnomad_nfe", "gnomad_nfe_est", "gnomad_nfe_nwe", "gnomad_nfe_onf", "gnomad_oth",
]
RAW_VARIANTS = struct(
    "chrom_b37 string, pos_b37 long, chrom_b38 string, pos_b38 long, ref string, alt string, rsid string",
    vep=struct(
        "most_severe_consequence string",
        transcript_consequences=ArrayType(struct("gene_id string, consequence_terms array<string>")),
    ),
    cadd=struct("raw double, phred double"),
    af=struct(", ".join(f"{x} double" for x in FREQUENCIES)),
)
V2G = struct(
    "chr_id string, position long, ref_allele string, alt_allele string, gene_id string, feature string, type_id string, "
    "source_id string, fpred_labels array<string>, fpred_scores array<double>, fpred_max_label string, fpred_max_score double, "
    "qtl_beta double, qtl_se double, qtl_pval double, qtl_score double, interval_score double, qtl_score_q double, "
    "interval_score_q double, d long, distance_score double, distance_score_q double"
)
V2D = struct(
    "study_id string, source string, pmid string, pub_date string, pub_journal string, pub_title string, pub_author string, "
    "has_sumstats boolean, trait_reported string, trait_efos array<string>, ancestry_initial array<string>, "
    "ancestry_replication array<string>, n_initial long, n_replication long, n_cases long, trait_category string, "
    "num_assoc_loci long, lead_chrom string, lead_pos long, lead_ref string, lead_alt string, tag_chrom string, tag_pos long, "
    "tag_ref string, tag_alt string, overall_r2 double, AFR_1000G_prop double, AMR_1000G_prop double, EAS_1000G_prop double, "
    "EUR_1000G_prop double, SAS_1000G_prop double, log10_ABF double, posterior_prob double, odds_ratio double, "
    "oddsr_ci_lower double, oddsr_ci_upper double, direction string, beta double, beta_ci_lower double, beta_ci_upper double, "
    "pval_mantissa double, pval_exponent long, pval double"
)
MANHATTAN = struct(
    "study string, chrom string, pos long, ref string, alt string, pval double, pval_mantissa double, pval_exponent long, "
    "odds double, oddsL double, oddsU double, direction string, beta double, betaL double, betaU double, credibleSetSize long, "
    "ldSetSize long, uniq_variants long, top10_genes_raw_ids array<string>, top10_genes_raw_score array<double>, "
    "top10_genes_coloc_ids array<string>, top10_genes_coloc_score array<double>, top10_genes_l2g_ids array<string>, "
    "top10_genes_l2g_score array<double>"
)
MANHATTAN_REQUIRED = ["study", "chrom", "pos", "ref", "alt", "pval", "pval_mantissa", "pval_exponent"]
EVIDENCE_SCORES = ["fpred_max_score", "qtl_score_q", "interval_score_q", "distance_score_q"]
