"""Scores joined back, a summary of each locus, and export tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..functions import filters
from ..operators import aggregates, joins, windows
from ..sources.shared import staged
from . import variant_disease as vd
from . import variant_gene as vg


def scored_datasets(
    v2g: DataFrame, d2v2g: DataFrame, weights: Mapping[str, float] = S.SOURCE_WEIGHTS, scores: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both tables with overall scores; pairs without any weighted source vanish from both. ``scores``: those of v2g, if they are written already."""
    if scores is None:
        scores = staged(vg.evidence_scores(v2g, weights), "scores")
    as_tags = scores.withColumnsRenamed(dict(zip(S.VARIANT_KEY, S.TAG_KEY, strict=True)))
    return v2g.join(scores, [*S.VARIANT_KEY, "gene_id"]), d2v2g.join(as_tags, [*S.TAG_KEY, "gene_id"])


def scored_disease(v2d: DataFrame, v2g: DataFrame, scores: DataFrame) -> DataFrame:
    """Rows of disease_variant_gene with overall scores, where these two tables are at hand: scores join v2g before it multiplies v2d's
    rows, so that no product is dealt anew by gene."""
    return vd.disease_variant_gene(v2d, v2g.join(scores, [*S.VARIANT_KEY, "gene_id"]))


LEAD_NAMES = {"study_id": "study", "lead_chrom": "chrom", "lead_pos": "pos", "lead_ref": "ref", "lead_alt": "alt"}


def l2g_genes(l2g: DataFrame) -> DataFrame:
    return l2g.withColumnRenamed("study_id", "study").where(F.col("y_proba_full_model") >= S.MIN_PROBABILITY)


def raw_genes(d2v2g_scored: DataFrame) -> DataFrame:
    return d2v2g_scored.withColumnsRenamed(LEAD_NAMES)


#: Tag variants for each task that tells loci their genes.
TAGS = 50_000


def locus_tasks(v2d: DataFrame, tags: int = TAGS) -> int:
    return 1 + v2d.count() // tags


def locus_genes(v2d: DataFrame, scores: DataFrame, tags: int = TAGS) -> DataFrame:
    """Best score of each gene in each locus, straight from tag variants and the scores of variants' genes.

    A variant's genes travel in one row, so that a locus is sent one row a tag; they part only where they are grouped. Tasks are as many as
    ``tags`` rows of v2d ask for, as those rows grow tenfold there: v2d is counted, so stage it.
    """
    lists = scores.groupBy(*S.VARIANT_KEY).agg(F.collect_list(F.struct("gene_id", "overall_score")).alias("_genes"))
    met = vd.disease_variant_gene(v2d.select(*S.LEAD_KEY, *S.TAG_KEY, "overall_r2", "posterior_prob"), lists)
    dealt = met.select(*S.LEAD_KEY, "_genes").repartition(locus_tasks(v2d, tags), *S.LEAD_KEY)
    return aggregates.group_max(dealt.select(*S.LEAD_KEY, F.inline("_genes")), [*S.LEAD_KEY, "gene_id"], "overall_score")


def coloc_genes(v2d_coloc: DataFrame) -> DataFrame:
    return v2d_coloc.withColumnsRenamed({f"left_{c}": c for c in S.LOCUS_KEY}).where(
        (F.round("coloc_h4", 2) >= S.MIN_COLOC_H4) & (F.col("coloc_log2_h4_h3") >= F.log2(F.lit(float(S.MIN_COLOC_RATIO)))) & (F.col("right_type") != "gwas")
    )


def top_genes_l2g(l2g: DataFrame, n: int | None = None) -> DataFrame:
    return windows.top_n_by_group(l2g_genes(l2g), S.LOCUS_KEY, "gene_id", "y_proba_full_model", "top10_genes_l2g", n)


def top_genes_raw(d2v2g_scored: DataFrame, n: int | None = None) -> DataFrame:
    return windows.top_n_by_group(raw_genes(d2v2g_scored), S.LOCUS_KEY, "gene_id", "overall_score", "top10_genes_raw", n)


def top_genes_coloc(v2d_coloc: DataFrame, n: int | None = None) -> DataFrame:
    return windows.top_n_by_group(coloc_genes(v2d_coloc), S.LOCUS_KEY, "right_gene_id", "coloc_h4", "top10_genes_coloc", n)


#: Columns of a locus and the v2d columns they come from; the least p-value decides which row gives them all.
EFFECTS = {
    "pval": "pval", "pval_mantissa": "pval_mantissa", "pval_exponent": "pval_exponent", "odds": "odds_ratio", "oddsL": "oddsr_ci_lower",
    "oddsU": "oddsr_ci_upper", "direction": "direction", "beta": "beta", "betaL": "beta_ci_lower", "betaU": "beta_ci_upper",
}


def _locus_parts(v2d: DataFrame) -> tuple[DataFrame, list[str], Column, dict, dict]:
    """Arguments of the distinct counts: v2d by locus, its tag variants, which are counted, and its effect columns."""
    counts = {"credibleSetSize": F.col("posterior_prob") > 0, "ldSetSize": F.col("overall_r2") > 0, "uniq_variants": None}
    return v2d.withColumnsRenamed(LEAD_NAMES), S.LOCUS_KEY, F.struct(*S.TAG_KEY), counts, {k: F.col(v) for k, v in EFFECTS.items()}


def locus_summary(v2d: DataFrame) -> DataFrame:
    """Effect of each lead variant, from its row with the least p-value, and how many tag variants stand for it by which evidence."""
    return aggregates.conditional_distinct(*_locus_parts(v2d))


def manhattan(
    v2d: DataFrame, d2v2g_scored: DataFrame, v2d_coloc: DataFrame, l2g: DataFrame, n: int | None = None, tasks: int | None = None
) -> DataFrame:
    """One row per locus with its best genes by three measures; required columns may not be null.

    All four inputs are reduced to one row per locus and tag or gene, then stand one under another, and one
    aggregation by locus makes the counts and the lists: one exchange on the locus key, no join.

    tasks: d2v2g_scored is dealt out by lead variant to so many tasks, as locus_genes does. The other inputs are dealt out by locus to as many,
    so that they stand beside its rows and no row moves twice (Spark 4.1 sees that their union is dealt out alike; others deal it once more).
    """
    counts = _locus_parts(v2d)[3]

    def dealt(df: DataFrame) -> DataFrame:
        return df if tasks is None else df.repartition(tasks, *S.LOCUS_KEY)

    named, *parts = _locus_parts(v2d)
    if tasks is not None:
        named = dealt(named.select(*S.LOCUS_KEY, *S.TAG_KEY, "overall_r2", "posterior_prob", *EFFECTS.values()))
    tags = aggregates.distinct_keys(named, *parts).drop("_key")
    lists = {
        "top10_genes_raw": (raw_genes(d2v2g_scored), "gene_id", "overall_score"),
        "top10_genes_coloc": (dealt(coloc_genes(v2d_coloc).select(*S.LOCUS_KEY, "right_gene_id", "coloc_h4")), "right_gene_id", "coloc_h4"),
        "top10_genes_l2g": (dealt(l2g_genes(l2g).select(*S.LOCUS_KEY, "gene_id", "y_proba_full_model")), "gene_id", "y_proba_full_model"),
    }
    best = [windows.best_by_item(df, S.LOCUS_KEY, gene, score, n).withColumn("_list", F.lit(name)).withColumnRenamed(gene, "_id") for name, (df, gene, score) in lists.items()]
    whole = joins.union_evidence(tags, *best).groupBy(*S.LOCUS_KEY)
    gathered = {name: windows.ranked_list(F.col("_list") == name, "_id") for name in lists}
    found = whole.agg(F.min("_first").alias("_first"), *aggregates.distinct_counts(counts), *[c.alias(name) for name, c in gathered.items()])
    columns = [F.col(f"_first.{name}").alias(name) for name in EFFECTS]
    for name in lists:
        some = F.size(name) > 0
        columns += [F.when(some, F.col(f"{name}._id")).alias(f"{name}_ids"), F.when(some, F.col(f"{name}._score")).alias(f"{name}_score")]
    found = found.where(F.col("_first").isNotNull()).select(*S.LOCUS_KEY, *columns, *counts)
    return C.conform_schema(found, S.MANHATTAN, S.MANHATTAN_REQUIRED)


def dictionaries(variants: DataFrame, studies: DataFrame, traits: DataFrame, overlaps: DataFrame, genes: DataFrame) -> dict[str, DataFrame]:
    """Lookup tables by name."""
    return {
        "variant-index": C.flatten_structs(variants, ["cadd", "af"]),
        "study-index": vd.study_index(studies, traits),
        "overlap-index": vd.overlap_index(overlaps),
        "genes-index": vg.gene_index(genes),
    }


def search_tables(variants: DataFrame, studies: DataFrame, genes: DataFrame) -> dict[str, DataFrame]:
    """Projections for search, by name."""
    return {
        "variant": variants.select(C.compose_key(*S.VARIANT_KEY).alias("variant_id"), "rs_id"),
        "study": studies.select("study_id", "pmid", "num_assoc_loci", "pub_author", "pub_journal", "pub_title", "trait_reported"),
        "gene": genes.select("gene_id", "gene_name"),
    }


def table_stats(v2g: DataFrame) -> DataFrame:
    return filters.table_stats(v2g, "chr_id", S.CHROMOSOMES)
