"""The table operators themselves on inputs made from the star-schema tables, each with DuckDB SQL for the same rows.

Parts are variants, 10,000 bases apart on five chromosomes; suppliers are genes; order lines are predicted
consequences, QTL statistics, linked and fine-mapped variants; orders are studies with one locus each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..operators import joins, layout
from ..sources import io
from ..sources.shared import new_path, staged
from . import pipeline, summaries, variant_disease, variant_gene
from .demo import STUDIES, STUDY_ID, as_studies, as_traits, dealt, joined, query, r6, studies, study_key, table

STEP, GENE_STEP, INTERVAL_STEP = 10_000, 70_000, 50_000
TERM_SCORES = {"A": 0.9, "R": 0.2, "N": 0.0}


def chrom(k: str | Column) -> Column:
    return F.concat(F.lit("c"), ((F.col(k) if isinstance(k, str) else k) % 5).cast("string"))


def gene(k: str) -> Column:
    return F.concat(F.lit("S"), F.col(k).cast("string"))


def genes(spark, d) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(
        F.when(k % 13 == 0, "MT").otherwise(chrom(k)).alias("chr"), gene("s_suppkey").alias("gene_id"), F.col("s_name").alias("gene_name"),
        F.lit("").alias("description"), (F.col("s_acctbal") > 0).alias("fwdstrand"), F.array(k).alias("exons"), F.lit(None).cast("long").alias("tss"),
        (k * GENE_STEP).alias("start"), (k * GENE_STEP + 300).alias("end"), F.when(k % 3 == 0, "protein_coding").when(k % 3 == 1, "lincRNA").otherwise("pseudogene").alias("biotype"),
    )


GENES = f"""(SELECT * FROM (SELECT s_suppkey AS g, 'S' || s_suppkey AS gene_id, s_name AS gene_name, CASE WHEN s_suppkey % 13 = 0 THEN 'MT' ELSE 'c' || s_suppkey % 5 END AS chr,
    s_suppkey * {GENE_STEP} + CASE WHEN s_acctbal > 0 THEN 0 ELSE 300 END AS tss, s_suppkey % 3 = 0 AS coding, s_suppkey % 3 AS biotype FROM supplier) WHERE chr <> 'MT' AND biotype <> 2)"""


def raw_variants(spark, d, alt: Column | None = None) -> DataFrame:
    """Parts with the lines that name them as consequences; parts without lines have none."""
    k = F.col("p_partkey")
    hit = F.struct(gene("l_suppkey").alias("gene_id"), F.array("l_returnflag", "l_linestatus").alias("consequence_terms"))
    hits = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.collect_list(hit).alias("transcript_consequences"))
    size = F.col("p_size").cast("double")
    return table(spark, d, "part").join(hits, "p_partkey", "left").select(
        chrom(k).alias("chrom_b37"), (k * STEP + 1).alias("pos_b37"), chrom(k).alias("chrom_b38"), (k * STEP).alias("pos_b38"), F.lit("A").alias("ref"),
        (F.lit("T") if alt is None else alt).alias("alt"), F.col("p_name").alias("rsid"), F.struct(F.col("p_type").alias("most_severe_consequence"), "transcript_consequences").alias("vep"),
        F.struct(F.col("p_retailprice").alias("raw"), size.alias("phred")).alias("cadd"), F.struct(*[(size / 100).alias(x) for x in S.FREQUENCIES]).alias("af"),
    )


@query(
    "variant_index",
    f"""WITH v AS (SELECT p_partkey, p_name, 'c' || p_partkey % 5 AS chr, p_partkey * {STEP} AS pos, CASE WHEN p_size <= 40 THEN p_brand END AS alt FROM part),
        p AS (SELECT p_partkey, gene_id, coding, abs(pos - tss) AS d FROM v JOIN {GENES} g ON g.chr = v.chr AND abs(pos - tss) <= 200000),
        a AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY d, gene_id) AS r FROM p),
        b AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY d, gene_id) AS r FROM p WHERE coding)
        SELECT chr AS chr_id, pos AS position, alt AS alt_allele, pos + 1 AS position_b37, p_name AS rs_id, a.d AS gene_id_any_distance, a.gene_id AS gene_id_any,
            b.d AS gene_id_prot_coding_distance, b.gene_id AS gene_id_prot_coding
        FROM v LEFT JOIN (FROM a WHERE r = 1) a USING (p_partkey) LEFT JOIN (FROM b WHERE r = 1) b USING (p_partkey)""",
)
def _(spark, d):
    """A fifth of the variants has no alternate allele: such a null is a key like any other."""
    alt = F.when(F.col("p_size") <= 40, F.col("p_brand"))
    found = variant_gene.variant_index(raw_variants(spark, d, alt), genes(spark, d), 200_000)
    return found.select(
        "chr_id", "position", "alt_allele", "position_b37", "rs_id", "gene_id_any_distance", "gene_id_any", "gene_id_prot_coding_distance", "gene_id_prot_coding"
    )


def consequence_scores(spark) -> DataFrame:
    rows = [(f"http://x/SO_{t}/", t, "", "", "", s, s) for t, s in TERM_SCORES.items()]
    return spark.createDataFrame(rows, S.CONSEQUENCE_SCORES)


VEP = """(SELECT l_partkey AS p, l_suppkey AS g, string_agg(t, ',' ORDER BY t) AS labels, max(s) AS q, min(CASE WHEN s = m THEN t END) AS best
    FROM (SELECT *, max(s) OVER (PARTITION BY l_partkey, l_suppkey) AS m FROM (SELECT DISTINCT l_partkey, l_suppkey, l_returnflag AS t,
          CASE l_returnflag WHEN 'A' THEN 0.9 WHEN 'R' THEN 0.2 ELSE 0.0 END::DOUBLE AS s FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part)))
    GROUP BY 1, 2 HAVING max(s) > 0)"""


@query("consequence_evidence", f"SELECT p * {STEP} AS position, 'S' || g AS gene_id, labels, best AS fpred_max_label, q AS fpred_max_score, 'vep' AS source_id FROM {VEP}")
def _(spark, d):
    found = variant_gene.consequence_evidence(raw_variants(spark, d), consequence_scores(spark))
    return found.select("position", "gene_id", joined("fpred_labels").alias("labels"), "fpred_max_label", "fpred_max_score", "source_id")


def variants(spark, d, least: int = 0) -> DataFrame:
    k = F.col("p_partkey")
    keys = [chrom(k).alias("chr_id"), (k * STEP).alias("position"), F.lit("A").alias("ref_allele"), F.lit("T").alias("alt_allele")]
    return table(spark, d, "part").where(F.col("p_size") > least).select(*keys)


DISTANCE = f"""(SELECT *, round(percent_rank() OVER (ORDER BY s NULLS FIRST), 1) AS q FROM (SELECT *, CASE WHEN d > 0 THEN 1.0::DOUBLE / d ELSE 1.0 END AS s
    FROM (SELECT p_partkey AS p, g.g, abs(p_partkey * {STEP} - tss) AS d FROM part JOIN {GENES} g ON chr = 'c' || p_partkey % 5 AND abs(p_partkey * {STEP} - tss) <= 500000)))"""


@query("distance_evidence_table", f"SELECT p * {STEP} AS position, 'S' || g AS gene_id, d, round(s, 9) AS distance_score, q AS distance_score_q, 'canonical_tss' AS source_id FROM {DISTANCE}")
def _(spark, d):
    found = variant_gene.distance_evidence(variants(spark, d), variant_gene.gene_index(genes(spark, d)))
    return found.select("position", "gene_id", "d", F.round("distance_score", 9).alias("distance_score"), "distance_score_q", "source_id")


def qtl(spark, d) -> DataFrame:
    k = F.col("l_partkey")
    return table(spark, d, "lineitem").select(
        chrom(k).alias("chrom"), (k * STEP).alias("pos"), F.lit("A").alias("other_allele"), F.lit("T").alias("effect_allele"), gene("l_suppkey").alias("ensembl_id"),
        F.col("l_tax").alias("beta"), F.col("l_quantity").alias("se"), F.col("l_discount").alias("pval"), F.lit("qtl").alias("type"),
        F.when(F.col("l_returnflag") == "R", "sqtl").otherwise("eqtl").alias("source"), F.col("l_linestatus").alias("bio_feature"),
    )


QTL = """(SELECT l_partkey AS p, l_suppkey AS g, source, l_linestatus AS feature, l_tax AS beta, l_quantity AS se, pv, s,
        round(percent_rank() OVER (PARTITION BY source, l_linestatus ORDER BY s NULLS FIRST), 1) AS q
    FROM (SELECT *, -log10(pv) AS s FROM (SELECT *, CASE WHEN l_discount = 0 THEN 5e-324 ELSE l_discount END AS pv, CASE l_returnflag WHEN 'R' THEN 'sqtl' ELSE 'eqtl' END AS source
          FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > {least}))))"""


@query(
    "qtl_evidence",
    f"SELECT p * {STEP} AS position, 'S' || g AS gene_id, source AS source_id, feature, beta AS qtl_beta, se AS qtl_se, round(s, 6) AS qtl_score, q AS qtl_score_q FROM {QTL.format(least=10)}",
)
def _(spark, d):
    found = variant_gene.qtl_evidence(qtl(spark, d), variants(spark, d, 10))
    return found.select("position", "gene_id", "source_id", "feature", "qtl_beta", "qtl_se", r6("qtl_score").alias("qtl_score"), "qtl_score_q")


INTERVAL_SOURCES = {"Javierre2016": "s_nationkey < 12", "Jung2019": "s_nationkey >= 12"}
INTERVALS = "chrom string, start long, end long, gene_id string, score double, cell_type string, bio_feature string"


def intervals(spark, d) -> DataFrame:
    """Interval files in folders whose names tell type and source; each interval stands there twice with another score."""
    base, k = new_path(spark, "files"), F.col("s_suppkey")
    rows = table(spark, d, "supplier").select(
        "s_nationkey", chrom(k).alias("chrom"), (k * INTERVAL_STEP).alias("start"), (k * INTERVAL_STEP + F.col("s_nationkey") * STEP).alias("end"), gene("s_suppkey").alias("gene_id"),
        F.explode(F.array("s_acctbal", F.col("s_acctbal") - 1)).alias("score"), F.lit("cell").alias("cell_type"), F.concat(F.lit("n"), (F.col("s_nationkey") % 3).cast("string")).alias("bio_feature"),
    )
    for source, own in INTERVAL_SOURCES.items():
        io.write_table(rows.where(own).drop("s_nationkey"), f"{base}/interval/PCHIC/{source}/1")
    return variant_gene.scan_intervals(spark, f"{base}/interval/*/*/*", INTERVALS)


INTERVAL = f"""(SELECT *, CASE WHEN s IS NOT NULL THEN round(percent_rank() OVER (PARTITION BY source, feature ORDER BY s NULLS FIRST), 1) END AS q FROM (
    SELECT p_partkey AS p, s_suppkey AS g, CASE WHEN s_nationkey < 12 THEN 'javierre2016' ELSE 'jung2019' END AS source, 'n' || s_nationkey % 3 AS feature, s_acctbal AS s
    FROM supplier JOIN part ON p_partkey % 5 = s_suppkey % 5 AND p_partkey * {STEP} BETWEEN s_suppkey * {INTERVAL_STEP} AND s_suppkey * {INTERVAL_STEP} + s_nationkey * {STEP}))"""


@query(
    "interval_evidence_table",
    f"SELECT p * {STEP} AS position, 'S' || g AS gene_id, 'pchic' AS type_id, source AS source_id, feature, round(s, 6) AS interval_score, q AS interval_score_q FROM {INTERVAL}",
)
def _(spark, d):
    found = variant_gene.interval_evidence(intervals(spark, d), variants(spark, d), 100_000)
    return found.select("position", "gene_id", "type_id", "source_id", "feature", r6("interval_score").alias("interval_score"), "interval_score_q")


LENGTHS = f"(SELECT s_suppkey, 'c' || s_suppkey % 5 AS chr, s_suppkey * {INTERVAL_STEP} AS s, s_suppkey * {INTERVAL_STEP} + (1 << (s_suppkey % 28)) - 1 AS e FROM supplier)"


@query(
    "interval_join_lengths",
    f"SELECT s_suppkey, p_partkey FROM {LENGTHS} i JOIN part ON chr = 'c' || p_partkey % 5 AND p_partkey * {STEP} BETWEEN s AND e",
)
def _(spark, d):
    """Intervals from one base to more than a whole chromosome."""
    k = F.col("s_suppkey")
    start = k * INTERVAL_STEP
    spans = table(spark, d, "supplier").select("s_suppkey", chrom(k).alias("chr_id"), start.alias("start"), (start + F.expr("shiftleft(1L, cast(s_suppkey % 28 as int))") - 1).alias("end"))
    points = table(spark, d, "part").select("p_partkey", chrom("p_partkey").alias("chr_id"), (F.col("p_partkey") * STEP).alias("position"))
    return joins.interval_join(spans, points, ["chr_id"], "start", "end", "position", 1_000).select("s_suppkey", "p_partkey")


@query("file_provenance", "SELECT CASE WHEN s_nationkey < 12 THEN 'javierre2016' ELSE 'jung2019' END AS source, 'S' || s_suppkey AS gene_id, 2 AS n FROM supplier")
def _(spark, d):
    tokens = C.path_tokens(F.col("filename"), "/interval/")
    return intervals(spark, d).groupBy(F.get(tokens, F.lit(1)).alias("source"), "gene_id").agg(F.count("*").cast("int").alias("n"))


# studies, loci and their tags


def effects(spark, d) -> DataFrame:
    """One locus for each order: its lead variant is the order's first part."""
    best = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("k"), F.max("l_quantity").alias("m"), F.max("l_suppkey").alias("e"), F.max("l_tax").alias("beta"), F.max("l_discount").alias("odds_ratio")
    )
    return best.withColumns({"e": -(F.col("e") % 20), "direction": F.lit("+")})


def loci(once: DataFrame) -> DataFrame:
    """The loci; some stand twice, the second time with another effect: better by an order of magnitude at odd positions, else worse."""
    other = {"e": F.col("e") + F.when(F.col("k") % 2 == 1, -1).otherwise(1), "beta": F.col("beta") + 2, "odds_ratio": F.col("odds_ratio") + 3, "direction": F.lit("-")}
    return once.unionByName(once.where("k % 7 = 0").withColumns(other)).select(
        study_key("l_orderkey"), chrom("k").alias("chrom"), (F.col("k") * STEP).alias("pos"), F.lit("A").alias("ref"), F.lit("T").alias("alt"), "direction",
        "beta", (F.col("beta") - 1).alias("beta_ci_lower"), (F.col("beta") + 1).alias("beta_ci_upper"), "odds_ratio", (F.col("odds_ratio") - 1).alias("oddsr_ci_lower"),
        (F.col("odds_ratio") + 1).alias("oddsr_ci_upper"), F.col("m").alias("pval_mantissa"), F.col("e").alias("pval_exponent"), F.lit("rs").alias("rsid"),
    )


def leads(once: DataFrame) -> DataFrame:
    place = [chrom("k").alias("lead_chrom"), (F.col("k") * STEP).alias("lead_pos"), F.lit("A").alias("lead_ref"), F.lit("T").alias("lead_alt")]
    return once.select(study_key("l_orderkey"), *place)


def tags(spark, d, once: DataFrame, rows: str, value: str, name: str, **extra: Column) -> DataFrame:
    k = F.col("l_partkey")
    best = table(spark, d, "lineitem").where(rows).groupBy(study_key("l_orderkey"), "l_partkey").agg(F.max(value).alias(name)).join(leads(once), "study_id")
    tag = [chrom(k).alias("tag_chrom"), (k * STEP).alias("tag_pos"), F.lit("A").alias("tag_ref"), F.lit("T").alias("tag_alt")]
    return best.select(*S.LEAD_KEY, *tag, name, *[c.alias(n) for n, c in extra.items()])


def ld(spark, d, once: DataFrame) -> DataFrame:
    shares = {f"{x}_1000G_prop": F.lit(0.5) for x in ("AFR", "AMR", "EAS", "EUR", "SAS")}
    return tags(spark, d, once, "l_returnflag <> 'R'", "l_discount", "overall_r2", ld_available=F.lit(True), pics_mu=F.lit(1.0), pics_postprob=F.lit(1.0), pics_99perc_credset=F.lit(True), **shares)


def finemapping(spark, d, once: DataFrame) -> DataFrame:
    return tags(spark, d, once, "l_linestatus = 'F'", "l_tax", "posterior_prob", log10_ABF=F.lit(1.5))


LOCI = f"""(SELECT {STUDY_ID.format(k='l_orderkey')} AS study_id, l_orderkey AS o, min(l_partkey) AS lead, max(l_quantity) AS m, -(max(l_suppkey) % 20) AS e, max(l_tax) AS beta,
    max(l_discount) AS odds FROM lineitem GROUP BY l_orderkey)"""
LOCI_ROWS = f"""(SELECT study_id, lead, m, e, beta, odds, '+' AS dir FROM {LOCI}
    UNION ALL SELECT study_id, lead, m, e + CASE lead % 2 WHEN 1 THEN -1 ELSE 1 END, beta + 2, odds + 3, '-' FROM {LOCI} WHERE lead % 7 = 0)"""
FINEMAP = f"(SELECT {STUDY_ID.format(k='l_orderkey')} AS study_id, lead, l_partkey AS tag, max(l_tax) AS pp FROM lineitem JOIN {LOCI} l ON o = l_orderkey WHERE l_linestatus = 'F' GROUP BY l_orderkey, lead, l_partkey)"


@query("finemap_index", f"SELECT study_id, lead * {STEP} AS lead_pos, tag * {STEP} AS tag_pos, pp AS posterior_prob, 1.5::DOUBLE AS \"log10_ABF\" FROM {FINEMAP}")
def _(spark, d):
    return variant_disease.finemap_index(finemapping(spark, d, effects(spark, d))).select("study_id", "lead_pos", "tag_pos", "posterior_prob", "log10_ABF")


@query(
    "top_loci",
    f"SELECT study_id, 'c' || lead % 5 AS lead_chrom, lead * {STEP} AS lead_pos, round(log10(m) + e, 6) AS log_pval, m AS pval_mantissa, e AS pval_exponent, beta, odds AS odds_ratio FROM {LOCI_ROWS}",
)
def _(spark, d):
    found = variant_disease.top_loci(loci(effects(spark, d)))
    return found.select("study_id", "lead_chrom", "lead_pos", r6(F.log10("pval")).alias("log_pval"), "pval_mantissa", "pval_exponent", "beta", "odds_ratio")


def overlaps(spark, d) -> DataFrame:
    sides = [("A", study_key("l_orderkey"), "l_partkey"), ("B", gene("l_suppkey"), "l_suppkey")]
    keys = [
        c for s, study, k in sides
        for c in (study.alias(f"{s}_study_id"), chrom(k).alias(f"{s}_chrom"), F.col(k).alias(f"{s}_pos"), F.lit("A").alias(f"{s}_ref"), F.lit("T").alias(f"{s}_alt"))
    ]
    counts = [F.col("l_linenumber").cast("long").alias("A_distinct"), F.col("l_quantity").cast("long").alias("AB_overlap"), F.lit(1).cast("long").alias("B_distinct")]
    return table(spark, d, "lineitem").select(*keys, *counts, F.col("l_returnflag").alias("set_type"))


OVERLAPS = f"""SELECT {STUDY_ID.format(k='l_orderkey')} AS "A_study_id", 'c' || l_partkey % 5 AS "A_chrom", l_partkey AS "A_pos", 'A' AS "A_ref", 'T' AS "A_alt",
    'S' || l_suppkey AS "B_study_id", 'c' || l_suppkey % 5 AS "B_chrom", l_suppkey AS "B_pos", 'A' AS "B_ref", 'T' AS "B_alt",
    CAST(l_linenumber AS BIGINT) AS "A_distinct", CAST(l_quantity AS BIGINT) AS "AB_overlap", 1::BIGINT AS "B_distinct" FROM lineitem"""


@query("overlap_index", OVERLAPS)
def _(spark, d):
    return variant_disease.overlap_index(overlaps(spark, d))


@query("sort_within_partitions", f"SELECT gene_id, tss FROM {GENES}")
def _(spark, d):
    return layout.sort_within(variant_gene.gene_index(genes(spark, d)), ["gene_id"]).select("gene_id", "tss")


@query(
    "dictionaries",
    f"""SELECT 'variant-index' AS kind, 'c' || p_partkey % 5 || '_' || p_partkey * {STEP} AS id, p_name AS name, round(p_retailprice, 6) AS a, round(p_size / 100.0, 6) AS b FROM part
        UNION ALL SELECT 'study-index', study_id, trait_category, NULL, NULL FROM ({STUDIES})
        UNION ALL SELECT 'overlap-index', "A_study_id", "B_study_id", "AB_overlap", "A_distinct" FROM ({OVERLAPS})
        UNION ALL SELECT 'genes-index', gene_id, gene_name, tss, NULL FROM {GENES}""",
)
def _(spark, d):
    indexed = variant_gene.variant_index(raw_variants(spark, d), genes(spark, d))
    found = summaries.dictionaries(indexed, as_studies(spark, d), as_traits(spark, d), overlaps(spark, d), genes(spark, d))
    none = F.lit(None).cast("double")
    columns = {
        "variant-index": (C.compose_key("chr_id", "position"), F.col("rs_id"), r6("raw"), r6("gnomad_oth")),
        "study-index": (F.col("study_id"), F.col("trait_category"), none, none),
        "overlap-index": (F.col("A_study_id"), F.col("B_study_id"), F.col("AB_overlap").cast("double"), F.col("A_distinct").cast("double")),
        "genes-index": (F.col("gene_id"), F.col("gene_name"), F.col("tss").cast("double"), none),
    }
    assert set(columns) == set(found)
    return joins.union_evidence(*[found[k].select(F.lit(k).alias("kind"), *[c.alias(n) for c, n in zip(own, ("id", "name", "a", "b"), strict=True)]) for k, own in columns.items()])


def l2g(spark, d, once: DataFrame) -> DataFrame:
    names = {"lead_chrom": "chrom", "lead_pos": "pos", "lead_ref": "ref", "lead_alt": "alt"}
    lines = table(spark, d, "lineitem")
    best = lines.groupBy("l_orderkey", "l_suppkey").agg((F.max("l_quantity") / 50).alias("y_proba_full_model"))
    best = dealt(best.select(study_key("l_orderkey"), gene("l_suppkey").alias("gene_id"), "y_proba_full_model"), lines, "study_id")
    return best.join(leads(once), "study_id").withColumnsRenamed(names)


L2G = f"""(SELECT study_id, lead, string_agg('S' || g, ',' ORDER BY y DESC, 'S' || g DESC) AS ids, string_agg(CAST(CAST(round(y * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY y DESC) AS scores
    FROM (SELECT l_orderkey AS o, l_suppkey AS g, max(l_quantity) / 50 AS y FROM lineitem GROUP BY 1, 2) JOIN {LOCI} l USING (o) WHERE y >= 0.5 GROUP BY study_id, lead)"""


def scores_of(c: str, scale: int = 100) -> Column:
    return F.concat_ws(",", F.transform(c, lambda x: F.round(x * scale).cast("long").cast("string")))


@query("top_genes_l2g", f"SELECT study_id AS study, lead * {STEP} AS pos, ids, scores FROM {L2G}")
def _(spark, d):
    found = summaries.top_genes_l2g(l2g(spark, d, effects(spark, d)))
    return found.select("study", "pos", joined("top10_genes_l2g_ids").alias("ids"), scores_of("top10_genes_l2g_score").alias("scores"))


def coloc(spark, d, once: DataFrame) -> DataFrame:
    o, g, k = F.col("l_orderkey"), F.col("l_suppkey"), F.col("l_partkey")
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_suppkey", "l_partkey", "l_returnflag").agg(F.max("l_discount").alias("x"))
    left = leads(once).select(F.col("study_id").alias("left_study"), *[F.col(f"lead_{c}").alias(f"left_{c}") for c in ("chrom", "pos", "ref", "alt")])
    rows = lines.withColumn("left_study", study_key("l_orderkey")).join(left, "left_study")
    return rows.select(
        *[f"left_{c}" for c in S.LOCUS_KEY], F.lit("gwas").alias("left_type"), F.lit("right").alias("right_study"), chrom(k).alias("right_chrom"), (k * STEP).alias("right_pos"),
        F.lit("A").alias("right_ref"), F.lit("T").alias("right_alt"), F.when(F.col("l_returnflag") == "R", "gwas").otherwise("eqtl").alias("right_type"),
        F.when(g % 6 != 0, gene("l_suppkey")).alias("right_gene_id"), F.when(o % 4 == 0, float("nan")).when(o % 7 != 0, F.col("x")).alias("coloc_h3"), (1 - F.col("x")).alias("coloc_h4"),
        F.lit(3.0).alias("coloc_log2_h4_h3"),
    )


COLOC_GENES = f"""(SELECT study_id, lead, count(DISTINCT gene) AS n, CAST(round(max(h4) * 100) AS BIGINT) AS top FROM (
    SELECT study_id, lead, CASE WHEN l_suppkey % 6 <> 0 THEN 'S' || l_suppkey END AS gene, 1 - max(l_discount) AS h4 FROM lineitem JOIN {LOCI} l ON o = l_orderkey
    WHERE o % 4 <> 0 AND l_returnflag <> 'R' AND l_partkey IN (SELECT p_partkey FROM part) GROUP BY study_id, lead, l_orderkey, l_suppkey, l_partkey, l_returnflag) c
    WHERE round(h4, 2) >= 0.95 AND (gene IS NULL OR EXISTS (SELECT 1 FROM {GENES} g WHERE g.gene_id = gene AND g.chr = 'c' || lead % 5)) GROUP BY 1, 2)"""

WEIGHT = "CASE source WHEN 'vep' THEN 1.0 WHEN 'sqtl' THEN 1.0 WHEN 'eqtl' THEN 0.66 ELSE 0.33 END"
#: Every locus with its summary and its best genes, from the raw tables.
RELEASE = f"""WITH g AS {GENES}, l AS {LOCI}, s AS ({STUDIES}),
    ev AS (SELECT p, g, 'vep' AS source, q FROM {VEP} UNION ALL SELECT p, g, 'canonical_tss', q FROM {DISTANCE} UNION ALL SELECT p, g, source, q FROM {QTL.format(least=0)}
           UNION ALL SELECT p, g, source, q FROM {INTERVAL}),
    sc AS (SELECT p, g, sum(w * s) / 4.97 AS overall FROM (SELECT p, g, source, max(coalesce(q, 0)) AS s, {WEIGHT} AS w FROM ev WHERE g IN (SELECT g.g FROM g) GROUP BY 1, 2, 3) GROUP BY 1, 2),
    t AS (SELECT l_orderkey AS o, l_partkey AS tag, max(l_discount) FILTER (l_returnflag <> 'R') AS r2, max(l_tax) FILTER (l_linestatus = 'F') AS pp
          FROM lineitem WHERE (l_returnflag <> 'R' OR l_linestatus = 'F') AND l_partkey IN (SELECT p_partkey FROM part) GROUP BY 1, 2),
    d AS (SELECT l.study_id, lead, tag, r2, pp FROM l JOIN s USING (study_id) JOIN t USING (o)),
    f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY study_id, lead ORDER BY e) AS r FROM {LOCI_ROWS}) WHERE r = 1),
    v AS (SELECT study_id, lead, count(DISTINCT CASE WHEN pp > 0 THEN tag END) AS credible, count(DISTINCT CASE WHEN r2 > 0 THEN tag END) AS ld, count(DISTINCT tag) AS uniq FROM d GROUP BY 1, 2),
    r AS (SELECT study_id, lead, string_agg('S' || g, ',' ORDER BY 'S' || g) AS ids, string_agg(CAST(CAST(round(x * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY x DESC) AS scores
          FROM (SELECT study_id, lead, sc.g, max(overall) AS x FROM d JOIN sc ON tag = p WHERE r2 IS NOT NULL OR pp IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2)
    SELECT v.study_id AS study, 'c' || v.lead % 5 AS chrom, v.lead * {STEP} AS pos, round(log10(m) + e, 6) AS log_pval, m AS pval_mantissa, e AS pval_exponent, odds, round(odds - 1, 6) AS "oddsL",
        dir AS direction, beta, round(beta + 1, 6) AS "betaU", credible AS "credibleSetSize", ld AS "ldSetSize", uniq AS uniq_variants, coalesce(r.ids, '') AS raw_ids, coalesce(r.scores, '') AS raw_scores,
        coalesce(c.n, -1) AS n_coloc, coalesce(c.top, -1) AS top_coloc, coalesce(x.ids, '') AS l2g_ids, coalesce(x.scores, '') AS l2g_scores
    FROM v JOIN f USING (study_id, lead) LEFT JOIN r USING (study_id, lead) LEFT JOIN {COLOC_GENES} c USING (study_id, lead) LEFT JOIN {L2G} x USING (study_id, lead)"""


def inputs(spark, d) -> dict[str, DataFrame]:
    once = staged(effects(spark, d), "effects")  # five of the inputs read it
    return {
        "raw_variants": staged(raw_variants(spark, d), "raw-variants"), "genes": genes(spark, d), "consequence_scores": consequence_scores(spark), "qtl": qtl(spark, d),
        "intervals": intervals(spark, d), "studies": as_studies(spark, d), "traits": as_traits(spark, d), "toploci": loci(once), "ld": ld(spark, d, once),
        "finemapping": finemapping(spark, d, once), "overlaps": overlaps(spark, d), "coloc": coloc(spark, d, once), "l2g": l2g(spark, d, once),
    }


#: Order lines for each bucket; a line makes about 28 rows of d2v2g.
BUCKET_LINES = 100_000


@query("build_all", RELEASE)
def _(spark, d):
    """The whole release from raw tables: every table is built and written; the last one is compared."""
    buckets = max(8, -(-table(spark, d, "lineitem").count() // BUCKET_LINES))
    whole = pipeline.build_all(spark, inputs(spark, d), new_path(spark, "release"), buckets=buckets)["manhattan"]
    # of equal scores the sums' last bits decide the order, so ids are compared as a set
    ids = F.array_join(F.array_sort("top10_genes_raw_ids"), ",")
    return whole.select(
        "study", "chrom", "pos", r6(F.log10("pval")).alias("log_pval"), "pval_mantissa", "pval_exponent", "odds", r6("oddsL").alias("oddsL"), "direction", "beta", r6("betaU").alias("betaU"),
        "credibleSetSize", "ldSetSize", "uniq_variants", F.coalesce(ids, F.lit("")).alias("raw_ids"), F.coalesce(scores_of("top10_genes_raw_score", 1_000_000), F.lit("")).alias("raw_scores"),
        F.coalesce(F.size(F.array_compact("top10_genes_coloc_ids")), F.lit(-1)).cast("long").alias("n_coloc"),
        F.coalesce(F.round(F.get("top10_genes_coloc_score", F.lit(0)) * 100).cast("long"), F.lit(-1)).alias("top_coloc"),
        F.coalesce(F.concat_ws(",", "top10_genes_l2g_ids"), F.lit("")).alias("l2g_ids"), F.coalesce(scores_of("top10_genes_l2g_score"), F.lit("")).alias("l2g_scores"),
    )
