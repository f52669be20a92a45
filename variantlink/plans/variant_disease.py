"""Studies, their lead variants and the variants these stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..functions import filters
from ..operators import joins, layout


def study_index(studies: DataFrame, traits: DataFrame) -> DataFrame:
    """Cleaned studies with their mapped traits; studies without a reported trait are dropped."""
    own = studies.drop("trait_efos", "trait_category")
    own = C.blank_to_null(own, ["pmid", "pub_date", "pub_journal", "pub_title", "pub_author", "trait_reported"])
    own = C.clean_arrays(own, ["ancestry_initial", "ancestry_replication"]).withColumn("source", C.id_prefix(F.col("study_id")))
    mapped = traits.select("study_id", "trait_efos", "trait_category")
    joined = joins.left_join_defaults(own, mapped, ["study_id"], {"trait_efos": [], "trait_category": "Uncategorised"})
    return filters.not_null(joined, ["trait_reported"])


def top_loci(loci: DataFrame, cluster: bool = True) -> DataFrame:
    """Lead variants with their p-value as one number, clustered for readers like ld_index."""
    pval = C.clamped_pow10(F.col("pval_mantissa"), F.col("pval_exponent"))
    names = {"chrom": "lead_chrom", "pos": "lead_pos", "ref": "lead_ref", "alt": "lead_alt"}
    own = loci.withColumn("pval", pval).withColumnsRenamed(names).drop("rsid")
    return layout.cluster_by_position(own, "lead_chrom", "lead_pos") if cluster else own


def ld_index(ld: DataFrame, cluster: bool = True) -> DataFrame:
    """Linked variants, clustered for readers; a join deals them anew by its own keys and asks for no clustering."""
    own = ld.drop("ld_available", "pics_mu", "pics_postprob", "pics_99perc_credset")
    return layout.cluster_by_position(own, "lead_chrom", "lead_pos") if cluster else own


def finemap_index(finemapping: DataFrame, cluster: bool = True) -> DataFrame:
    """Fine-mapped variants, clustered for readers like ld_index."""
    return layout.cluster_by_position(finemapping, "lead_chrom", "lead_pos") if cluster else finemapping


def overlap_index(overlaps: DataFrame) -> DataFrame:
    sides = [f"{s}_{c}" for s in "AB" for c in ("study_id", "chrom", "pos", "ref", "alt")]
    return overlaps.select(*sides, "A_distinct", "AB_overlap", "B_distinct")


def variant_disease(variants: DataFrame, studies: DataFrame, loci: DataFrame, ld: DataFrame, finemapping: DataFrame) -> DataFrame:
    """Lead variants of studies with their tag variants by linkage or fine mapping, indexed ones only."""
    evidence = joins.full_outer_evidence(ld_index(ld, cluster=False), finemap_index(finemapping, cluster=False), [*S.LEAD_KEY, *S.TAG_KEY])
    leads = loci.join(studies, ["study_id"])
    tagged = leads.join(evidence, S.LEAD_KEY)
    keys = variants.select(*[F.col(c).alias(f"_{c}") for c in S.VARIANT_KEY])
    known = joins.join_composite_key(tagged, keys, {t: f"_{c}" for t, c in zip(S.TAG_KEY, S.VARIANT_KEY, strict=True)})
    missing = {f.name: F.lit(None).cast(f.dataType) for f in S.V2D if f.name not in known.columns}
    return C.conform_schema(known.withColumns(missing), S.V2D)


def for_two_readers(v2d: DataFrame, partitions: int | None = None) -> DataFrame:
    """``v2d`` laid out once for readers by study and readers by tag position, instead of two sorted copies."""
    return layout.cluster_by_each(v2d, [["study_id"], ["tag_chrom", "tag_pos"]], partitions=partitions)


def disease_variant_gene(v2d: DataFrame, v2g: DataFrame) -> DataFrame:
    """Linked or fine-mapped tag variants with their genes."""
    keys = dict(zip(S.TAG_KEY, S.VARIANT_KEY, strict=True))
    return joins.join_composite_key(filters.any_evidence(v2d, ["overall_r2", "posterior_prob"]), v2g, keys)


def coloc_index(coloc: DataFrame, genes: DataFrame, variants: DataFrame) -> DataFrame:
    """Colocalised pairs whose gene, if any, lies on the left chromosome and whose right variant is indexed."""
    known = genes.select(F.col("chr").alias("_chr"), F.col("gene_id").alias("_gene"))
    kept = joins.null_or_match_join(coloc, known, {"right_gene_id": "_gene", "left_chrom": "_chr"}, "right_gene_id")
    kept = filters.not_nan(kept, "coloc_h3")
    keys = variants.select(*[F.col(c).alias(f"_{c}") for c in S.VARIANT_KEY])
    right = ["right_chrom", "right_pos", "right_ref", "right_alt"]
    return joins.join_composite_key(kept, keys, {r: f"_{c}" for r, c in zip(right, S.VARIANT_KEY, strict=True)})
