"""Evidence that links variants to genes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..functions import filters
from ..operators import aggregates, joins, layout, windows
from ..sources import io
from ..sources.shared import staged


def chosen_genes(genes: DataFrame, biotypes: Sequence[str]) -> DataFrame:
    """Genes of the biotypes, off the mitochondrion; a missing ``tss`` is derived from the strand."""
    tss = F.coalesce("tss", F.when(F.col("fwdstrand"), F.col("start")).otherwise(F.col("end")))
    return filters.in_not_in(genes, "biotype", biotypes, "chr", ["MT"]).withColumn("tss", tss)


def gene_index(genes: DataFrame, biotypes: Sequence[str] = S.APPROVED_BIOTYPES) -> DataFrame:
    """Genes of the biotypes, clustered by position."""
    return layout.cluster_by_position(chosen_genes(genes, biotypes), "chr", "tss")


def variant_index(raw: DataFrame, genes: DataFrame, max_distance: int = S.NEAREST_MAX_DISTANCE) -> DataFrame:
    """Variants with their nearest approved and nearest protein-coding gene within ``max_distance``."""
    variants = C.project_alias(
        raw,
        [
            ("chrom_b38", "chr_id"), ("pos_b38", "position"), ("ref", "ref_allele"), ("alt", "alt_allele"), ("chrom_b37", "chr_id_b37"),
            ("pos_b37", "position_b37"), ("rsid", "rs_id"), ("vep.most_severe_consequence", "most_severe_consequence"), ("cadd", "cadd"), ("af", "af"),
        ],
    )
    variants = filters.not_null(variants, ["chr_id", "position"])
    known = chosen_genes(genes, S.APPROVED_BIOTYPES).withColumnRenamed("chr", "chr_id")
    groups = {"gene_id_any": None, "gene_id_prot_coding": F.col("biotype").isin(S.PROTEIN_CODING)}
    found = joins.nearest_by(variants, known, ["chr_id"], "position", "tss", max_distance, "gene_id", groups)
    return layout.cluster_by_position(found, "chr_id", "position")


def consequence_evidence(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    """Predicted consequences of each variant and gene, and the one that scores most (above 0)."""
    scores = lookup.where(F.col("v2g_score").isNotNull()).withColumn("accession", C.accession_tail(F.col("accession")))
    named = filters.not_null(
        C.project_alias(
            raw,
            [("chrom_b38", "chr_id"), ("pos_b38", "position"), ("ref", "ref_allele"), ("alt", "alt_allele"), ("vep.transcript_consequences", "hits")],
        ),
        ["chr_id", "position", "hits"],
    )
    hits = C.explode_structs(named, "hits", ["gene_id", "consequence_terms"])
    terms = hits.select(*S.VARIANT_KEY, "gene_id", F.get("consequence_terms", F.lit(0)).alias("term"))
    best = aggregates.label_score_max(terms, [*S.VARIANT_KEY, "gene_id"], "term", scores, "v2g_score", "fpred")
    return C.with_labels(best, type_id="fpred", source_id="vep", feature="unspecified")


def distance_evidence(variants: DataFrame, genes: DataFrame, max_distance: int = S.EVIDENCE_MAX_DISTANCE, skew_safe: bool = True) -> DataFrame:
    """All genes near each variant, with distance score and percentile (one group: ranked skew-safe)."""
    near = genes.select(F.col("chr").alias("chr_id"), "gene_id", "tss")
    pairs = joins.band_join(variants.select(*S.VARIANT_KEY), near, ["chr_id"], "position", "tss", max_distance).drop("tss")
    pairs = C.with_labels(pairs, type_id="distance", source_id="canonical_tss", feature="unspecified")
    pairs = staged(pairs.withColumn("distance_score", C.inverse_distance(F.col("d"))), "near-pairs")  # ranking reads it more than once
    return windows.percentile_by(pairs, ["source_id", "feature"], "distance_score", "distance_score_q", skew_safe=skew_safe)


def qtl_evidence(qtl: DataFrame, variants: DataFrame, skew_safe: bool = True) -> DataFrame:
    """QTL statistics of indexed variants, with score and percentile."""
    names = {
        "chrom": "chr_id", "pos": "position", "other_allele": "ref_allele", "effect_allele": "alt_allele", "ensembl_id": "gene_id",
        "beta": "qtl_beta", "se": "qtl_se", "pval": "qtl_pval", "type": "type_id", "source": "source_id", "bio_feature": "feature",
    }
    named = qtl.withColumnsRenamed(names)
    pval = F.when(F.col("qtl_pval") == 0.0, F.lit(C.SMALLEST)).otherwise(F.col("qtl_pval"))
    scored = named.withColumn("qtl_pval", pval).withColumn("qtl_score", C.neg_log10(F.col("qtl_pval")))
    known = staged(joins.semi_join(scored, variants, S.VARIANT_KEY), "qtl")  # ranking reads it more than once
    return windows.percentile_by(known, ["source_id", "feature"], "qtl_score", "qtl_score_q", skew_safe=skew_safe)


def interval_evidence(
    intervals: DataFrame, variants: DataFrame, bin_width: int = 10_000, path: str = "filename", skew_safe: bool = True
) -> DataFrame:
    """Variants inside each interval; its type and source are read from its file's path (column ``path``)."""
    tokens = C.path_tokens(F.col(path), "/interval/")
    typed = intervals.withColumnRenamed("bio_feature", "feature").withColumns(
        {"type_id": F.get(tokens, F.lit(0)), "source_id": F.get(tokens, F.lit(1))}
    )
    keys = ["chrom", "start", "end", "gene_id", "type_id", "source_id", "feature"]
    best = aggregates.group_max(typed, keys, "score").withColumnsRenamed({"chrom": "chr_id", "score": "interval_score"})
    inside = joins.interval_join(best, variants.select(*S.VARIANT_KEY), ["chr_id"], "start", "end", "position", bin_width).drop("start", "end")
    inside = staged(inside, "inside")  # ranking reads it more than once
    return windows.percentile_by(inside, ["source_id", "feature"], "interval_score", "interval_score_q", skew_safe=skew_safe)


def scan_intervals(spark, path: str, schema: str) -> DataFrame:
    """Interval files with the path that tells their type and source."""
    return io.scan_parquet(spark, path, schema).withColumn("filename", io.file_path())


def variant_gene(components: Sequence[DataFrame], genes: DataFrame) -> DataFrame:
    """All evidence under one schema, restricted to the given genes."""
    whole = joins.union_evidence(*components, array_defaults=[c for c in ("fpred_labels", "fpred_scores") if any(c in t.columns for t in components)])
    missing = {f.name: F.array().cast(f.dataType) if f.name in ("fpred_labels", "fpred_scores") else F.lit(None).cast(f.dataType) for f in S.V2G if f.name not in whole.columns}
    return C.conform_schema(joins.semi_join(whole.withColumns(missing), genes, ["gene_id"]), S.V2G)


def evidence_scores(v2g: DataFrame, weights: Mapping[str, float] = S.SOURCE_WEIGHTS) -> DataFrame:
    return aggregates.weighted_source_score(v2g, [*S.VARIANT_KEY, "gene_id"], "source_id", S.EVIDENCE_SCORES, weights)
