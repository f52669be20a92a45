"""One-row scenarios through every table, and the whole pipeline."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from variantlink import schemas as S
from variantlink.plans import demo, pipeline, summaries, variant_disease, variant_gene
from variantlink.sources import io
from variantlink.sources.shared import new_path, shared_dir, staged

GENE, STUDY = "ENSG00000223972", "FINNGEN_R5_CD2_INSITU_MELANOMA_TRUNK"
SIDE = "study_id string, lead_chrom string, lead_pos long, lead_ref string, lead_alt string, tag_chrom string, tag_pos long, tag_ref string, tag_alt string"


@pytest.fixture(scope="module")
def inputs(spark):
    variant = ("1", 1100, "A", "T")
    raw = spark.createDataFrame(
        [("1", 1000, *variant[:2], "A", "T", "rs123", ("severe consequence", [(GENE, ["consequence term 1", "other"])]), (0.1, 0.2), tuple(x / 10 for x in range(1, 11)))],
        S.RAW_VARIANTS,
    )
    genes = [
        ("1", GENE, "DDX11L1", "helicase", True, [11869, 12227], None, 11869, 14412, "protein_coding"),
        ("MT", "ENSGMT", "MT", "", True, [1], 1100, 1100, 1200, "protein_coding"),
        ("1", "ENSGPS", "PS", "", True, [1], 1101, 1101, 1200, "pseudogene"),
        ("2", "ENSG2", "B", "", False, [1], None, 1, 1100, "lincRNA"),
    ]
    study = (
        STUDY, "trait 1", "PMID:1", "2012-01-03", "", "title", "Author", ["European=10", ""], None, 10, 5, 1, 2, True, ["old"], "old"
    )
    left = ("study2", *variant, "gwas", "study1", *variant, "eqtl")
    weights = "coloc_h0 double, coloc_h1 double, coloc_h2 double, coloc_h3 double, coloc_h4 double, coloc_h4_h3 double, coloc_log2_h4_h3 double"
    return {
        "raw_variants": raw,
        "genes": spark.createDataFrame(genes, S.GENES),
        "consequence_scores": spark.createDataFrame([("http://x/SO_1", "upstream", "", "", "MODIFIER", 0.0, 0.6)], S.CONSEQUENCE_SCORES),
        "qtl": spark.createDataFrame(
            [(*variant, GENE, 0.1, 0.2, 0.3, "type 1", "eqtl", "feature 1"), ("1", 999, "A", "T", GENE, 0.1, 0.2, 0.0, "type 1", "eqtl", "feature 1")],
            "chrom string, pos long, other_allele string, effect_allele string, ensembl_id string, beta double, se double, pval double, type string, source string, bio_feature string",
        ),
        "intervals": spark.createDataFrame(
            [("1", 900, 1200, GENE, s, "cell", "feature 1", "/x/interval/PCHIC/Jung2019/19/data.parquet") for s in (0.1, 0.4)] + [("1", 1200, 900, GENE, 0.1, "cell", "feature 1", "/x/interval/PCHIC/Jung2019/19/data.parquet")],
            "chrom string, start long, end long, gene_id string, score double, cell_type string, bio_feature string, filename string",
        ),
        "studies": spark.createDataFrame(
            [study, ("GCST1", "", *study[2:])],
            "study_id string, trait_reported string, pmid string, pub_date string, pub_journal string, pub_title string, pub_author string, ancestry_initial array<string>, "
            "ancestry_replication array<string>, n_initial long, n_replication long, n_cases long, num_assoc_loci long, has_sumstats boolean, trait_efos array<string>, trait_category string",
        ),
        "traits": spark.createDataFrame([(STUDY, "t", ["EFO_0000389"], "cancer")], "study_id string, trait_reported string, trait_efos array<string>, trait_category string"),
        "toploci": spark.createDataFrame(
            [(STUDY, *variant, "+", 0.026, 0.021, 0.030, 0.11, 0.09, 0.12, 2.3, -16, "rs1")],
            "study_id string, chrom string, pos long, ref string, alt string, direction string, beta double, beta_ci_lower double, beta_ci_upper double, odds_ratio double, "
            "oddsr_ci_lower double, oddsr_ci_upper double, pval_mantissa double, pval_exponent long, rsid string",
        ),
        "ld": spark.createDataFrame(
            [(STUDY, *variant, *variant, 0.9, 0.1, 0.2, 0.3, 0.4, 0.5, True), (STUDY, *variant, "9", 1, "A", "T", 0.9, 0.1, 0.2, 0.3, 0.4, 0.5, True)],
            f"{SIDE}, overall_r2 double, AFR_1000G_prop double, AMR_1000G_prop double, EAS_1000G_prop double, EUR_1000G_prop double, SAS_1000G_prop double, ld_available boolean",
        ),
        "finemapping": spark.createDataFrame([(STUDY, *variant, *variant, 28.9, 0.021)], f"{SIDE}, log10_ABF double, posterior_prob double"),
        "overlaps": spark.createDataFrame(
            [("a", *variant, "b", *variant, 7, 3, 5, "x")],
            "A_study_id string, A_chrom string, A_pos long, A_ref string, A_alt string, B_study_id string, B_chrom string, B_pos long, B_ref string, B_alt string, "
            "A_distinct long, AB_overlap long, B_distinct long, set_type string",
        ),
        "coloc": spark.createDataFrame(
            [(*left, g, None, None, None, h3, 0.96, None, 3.0) for g, h3 in ((GENE, 0.1), (None, None), ("ENSG2", 0.1), ("zz", 0.1), (GENE, float("nan")))],
            "left_study string, left_chrom string, left_pos long, left_ref string, left_alt string, left_type string, right_study string, right_chrom string, right_pos long, "
            f"right_ref string, right_alt string, right_type string, right_gene_id string, {weights}",
        ),
        "l2g": spark.createDataFrame([(STUDY, *variant, GENE, 0.5), (STUDY, *variant, "low", 0.49)], "study_id string, chrom string, pos long, ref string, alt string, gene_id string, y_proba_full_model double"),
    }


@pytest.fixture(scope="module")
def tables(spark, inputs):
    return pipeline.build_all(spark, inputs, new_path(spark, "release"))


def test_variant_index(tables):
    r = tables["variant-index"].collect()
    assert len(r) == 1 and r[0]["gene_id_any"] == r[0]["gene_id_prot_coding"] == GENE and r[0]["gene_id_any_distance"] == 10769
    assert (r[0]["chr_id_b37"], r[0]["position_b37"]) == ("1", 1000)


def test_evidence(tables):
    by = {r["type_id"]: r for r in tables["v2g"].collect()}
    assert set(by) == {"distance", "type 1", "pchic"} and tables["v2g"].count() == 3 and tables["v2g"].columns == S.V2G.names
    d = by["distance"]
    assert (d["d"], d["source_id"], d["feature"], d["distance_score_q"]) == (10769, "canonical_tss", "unspecified", 0.0)
    assert d["distance_score"] == pytest.approx(1 / 10769) and d["fpred_labels"] == []
    assert by["type 1"]["qtl_score"] == pytest.approx(0.522879) and by["pchic"]["interval_score"] == 0.4 and by["pchic"]["source_id"] == "jung2019"


def test_consequences(spark, inputs):
    lookup = inputs["consequence_scores"].withColumn("term", F.lit("consequence term 1")).withColumn("v2g_score", F.lit(0.7))
    r = variant_gene.consequence_evidence(inputs["raw_variants"], lookup).collect()
    assert [(x["fpred_labels"], x["fpred_scores"], x["fpred_max_label"], x["source_id"]) for x in r] == [(["consequence term 1"], [0.7], "consequence term 1", "vep")]


def test_disease_side(tables):
    v2d = tables["v2d"].collect()
    assert len(v2d) == 1 and v2d[0]["pval"] == pytest.approx(2.3e-16) and tables["v2d"].columns == S.V2D.names
    r = v2d[0]
    assert (r["source"], r["trait_efos"], r["trait_category"], r["pub_journal"], r["ancestry_initial"], r["ancestry_replication"]) == (
        "FINNGEN", ["EFO_0000389"], "cancer", None, ["European=10"], [],
    )
    assert (r["overall_r2"], r["posterior_prob"]) == (0.9, 0.021)
    assert tables["d2v2g"].count() == 3 and [x["study_id"] for x in tables["lut/study-index"].collect()] == [STUDY]


def test_coloc(tables):
    assert sorted((r["right_gene_id"] or "", r["coloc_h3"]) for r in tables["v2d_coloc"].collect()) == [("", None), (GENE, 0.1)]


def test_scores_and_summary(tables):
    scored = tables["d2v2g_scored"].collect()
    assert len(scored) == 3 and scored[0]["source_list"] == ["canonical_tss", "eqtl", "jung2019"] and scored[0]["overall_score"] == 0.0
    m = tables["manhattan"].collect()
    assert len(m) == 1 and tables["manhattan"].columns == S.MANHATTAN.names
    assert (m[0]["credibleSetSize"], m[0]["ldSetSize"], m[0]["uniq_variants"]) == (1, 1, 1)
    assert (m[0]["top10_genes_l2g_ids"], m[0]["top10_genes_raw_ids"], m[0]["top10_genes_coloc_ids"]) == ([GENE], [GENE], None)


def test_exports(tables):
    assert tables["lut/variant-index"].columns[-12:] == ["raw", "phred", *S.FREQUENCIES]
    assert {r["gene_id"] for r in tables["lut/genes-index"].collect()} == {GENE, "ENSG2"}
    assert "set_type" not in tables["lut/overlap-index"].columns and tables["lut/overlap-index"].count() == 1
    assert tables["search/variant"].first() == Row(variant_id="1_1100_A_T", rs_id="rs123")
    assert [tables[f"search/{k}"].count() for k in ("variant", "study", "gene")] == [1, 1, 2]


def test_top_genes_of_coloc(spark, inputs):
    pairs = inputs["coloc"].select(*[c for c in inputs["coloc"].columns if c not in ("coloc_h4", "right_type", "right_gene_id")]).limit(1)
    cases = spark.createDataFrame([("a", 0.945, "eqtl"), ("b", 0.944, "eqtl"), ("c", 0.99, "gwas"), ("d", 0.99, None), ("e", 0.99, "pqtl")], "right_gene_id string, coloc_h4 double, right_type string")
    got = summaries.top_genes_coloc(cases.crossJoin(pairs)).first()
    assert got["top10_genes_coloc_ids"][0] == "e" and not {"b", "c", "d"} & set(got["top10_genes_coloc_ids"])


def test_stats_and_missing_pvalue(spark, tables, inputs):
    assert tuple(summaries.table_stats(tables["v2g"]).first()) == (3, 3)
    broken = tables["v2d"].withColumn("pval", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="null in pval"):
        summaries.manhattan(broken, tables["d2v2g_scored"], tables["v2d_coloc"], inputs["l2g"]).collect()


def test_neither_evidence_is_left_out(tables):
    nothing = tables["v2d"].withColumns({"overall_r2": F.lit(None).cast("double"), "posterior_prob": F.lit(None).cast("double")})
    assert variant_disease.disease_variant_gene(nothing, tables["v2g"]).count() == 0


def test_locus_genes_like_the_joined_rows_in_one_exchange_by_locus(spark, tables):
    genes = [(tables["v2d"].first()["tag_chrom"], r["tag_pos"], r["tag_ref"], r["tag_alt"], f"g{k}", k / 8) for r in tables["v2d"].collect() for k in range(5)]
    scores = spark.createDataFrame(genes, "chr_id string, position long, ref_allele string, alt_allele string, gene_id string, overall_score double").distinct()
    twice = tables["v2d"].union(tables["v2d"])
    plain = variant_disease.disease_variant_gene(twice, scores).groupBy(*S.LEAD_KEY, "gene_id").agg(F.max("overall_score"))
    found = summaries.locus_genes(twice, scores, 1)
    assert sorted(found.collect()) == sorted(plain.collect()) and found.count() > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and not re.search(r"Exchange hashpartitioning\(study_id#\d+, .*gene_id", plan), plan  # rows of one gene each never move


def test_scores_joined_before_the_product_give_the_same_rows(tables):
    scores = tables["scores"] if "scores" in tables else variant_gene.evidence_scores(tables["v2g"])
    want = summaries.scored_datasets(tables["v2g"], tables["d2v2g"], scores=scores)[1]
    found = summaries.scored_disease(tables["v2d"], tables["v2g"], scores).select(*want.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect())) and found.count() > 0


def test_a_locus_that_stands_twice_gives_one_of_its_rows(tables, inputs):
    worse = {"pval": 1e-3, "pval_mantissa": 1.0, "pval_exponent": -3, "beta": -0.2, "direction": "-", "odds_ratio": None}
    kinds = dict(tables["v2d"].dtypes)
    twice = tables["v2d"].unionByName(tables["v2d"].withColumns({c: F.lit(v).cast(kinds[c]) for c, v in worse.items()}))
    want = tables["manhattan"].first()
    found = summaries.manhattan(twice, tables["d2v2g_scored"], tables["v2d_coloc"], inputs["l2g"])
    assert found.collect() == [want] and summaries.locus_summary(twice).first()["direction"] == "+"
    plan = found._jdf.queryExecution().executedPlan().toString()
    lines = [x.strip(" +-:|*") for x in plan.split("== Initial Plan ==")[0].splitlines()]
    by_locus = [x for x in lines if re.search(r"Exchange hashpartitioning\(study#\d+, chrom#\d+, pos#\d+L, ref#\d+, alt#\d+, \d+\)", x)]
    assert not [x for x in lines if x.startswith("Expand") or "Join" in x.split("[")[0]], lines
    assert len(by_locus) == 1
    capped = summaries.manhattan(twice, tables["d2v2g_scored"], tables["v2d_coloc"], inputs["l2g"], n=1)
    assert capped.collect() == [want]


def listing(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName(): s.getModificationTime() for s in files.listStatus(place)} if files.exists(place) else {}


@pytest.mark.parametrize("buckets", [None, 3])
def test_release_goes_on_after_a_failure(spark, inputs, tables, buckets, monkeypatch):
    out, shared = new_path(spark, "release"), shared_dir(spark)

    def lost(*_):
        raise RuntimeError("executors lost")

    before = set(listing(spark, shared))
    with monkeypatch.context() as m:
        m.setattr(variant_disease, "disease_variant_gene", lost)
        with pytest.raises(RuntimeError, match="lost"):
            pipeline.build_all(spark, inputs, out, buckets=buckets)
    assert not listing(spark, f"{out}/d2v2g") and set(listing(spark, shared)) - before == {out.rsplit("/", 1)[1]}  # nothing staged is left
    written = listing(spark, f"{out}/v2g"), listing(spark, f"{out}/v2d")

    def again(*_):
        raise AssertionError("made twice")

    with monkeypatch.context() as m:
        m.setattr(variant_gene, "variant_gene", again)
        m.setattr(variant_disease, "variant_disease", again)
        made = pipeline.build_all(spark, inputs, out, buckets=buckets)
    assert written == (listing(spark, f"{out}/v2g"), listing(spark, f"{out}/v2d"))
    for name, df in tables.items():
        assert sorted(map(repr, made[name].collect())) == sorted(map(repr, df.collect())), name
    done = pipeline.build_all(spark, inputs, out, buckets=buckets)  # nothing is left to do
    assert set(done) == set(made) and set(listing(spark, shared)) - before == {out.rsplit("/", 1)[1]}
    with pytest.raises(ValueError, match="something else"):
        pipeline.build_all(spark, inputs, out, weights={"eqtl": 1.0}, buckets=buckets)


def test_joins_of_bucketed_tables_move_nothing(spark, inputs):
    made = pipeline.build_all(spark, inputs, new_path(spark, "release"), buckets=3)
    with io.joined_in_buckets(spark):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for tables that are too large to broadcast
        both = variant_disease.disease_variant_gene(made["v2d"], made["v2g"])
        scored = summaries.scored_datasets(made["v2g"], made["d2v2g"], scores=made["scores"])
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (both, *scored)]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all("SortMergeJoin" in p and "Exchange" not in p for p in plans), plans
    with pytest.raises(ValueError, match="exists"):
        io.write_bucketed(made["v2g"], pipeline.Release(spark, {}, "/tmp").path("..").toString(), S.VARIANT_KEY, 3)


def test_release_makes_nothing_from_the_product(spark, inputs, monkeypatch):
    """d2v2g has many rows for each of v2d: it is written, but neither sorted nor read again."""
    read, write, bucketed = {}, io.write_table, io.write_bucketed

    def noted(write, df, path, *rest):
        read[path.rsplit("/", 1)[1]] = df.inputFiles()
        write(df, path, *rest)

    monkeypatch.setattr(io, "write_table", lambda *a: noted(write, *a))
    monkeypatch.setattr(io, "write_bucketed", lambda *a: noted(bucketed, *a))
    made = pipeline.build_all(spark, inputs, new_path(spark, "release"), buckets=3)
    assert len(read) == len(made) and not [name for name, files in read.items() if any("/d2v2g" in f for f in files)], read
    assert made["d2v2g"].count() > 0 and len(made["d2v2g"].inputFiles()) <= 3  # one file a bucket


def test_tags_of_orders_move_once_and_loci_are_not_clustered(spark):
    plan = demo.v2d(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and not re.search(r"Exchange hashpartitioning\(l_orderkey#\d+L, l_partkey", plan), plan


def test_release_sends_tables_to_tasks_by_rows_not_by_files(spark, tmp_path):
    """A file under Spark's limit may hold millions of rows: in build_all's block it is not sent through the driver unless its rows are few."""
    limits = [f"spark.sql.{x}autoBroadcastJoinThreshold" for x in ("", "adaptive.")]
    spark.range(400_000).select("id", F.lit("A").alias("a")).write.parquet(f"{tmp_path}/many")
    spark.range(100).select("id", F.lit("T").alias("b")).write.parquet(f"{tmp_path}/few")
    many, few, left = (spark.read.parquet(f"{tmp_path}/{x}") for x in ("many", "few", "many"))

    def plan(right):
        return left.select("id").join(right, "id")._jdf.queryExecution().sparkPlan().toString()

    before = [spark.conf.get(x, None) for x in limits]
    assert "BroadcastHashJoin" in plan(many)
    with io.broadcast_by_rows(spark):
        assert "BroadcastHashJoin" not in plan(many) and "BroadcastHashJoin" in plan(few)
        assert int(spark.conf.get(limits[1])) == 10 << 20
    assert before == [spark.conf.get(x, None) for x in limits]


def test_release_broadcasts_by_rows(spark, inputs, monkeypatch):
    seen = []
    make = variant_disease.variant_disease
    monkeypatch.setattr(variant_disease, "variant_disease", lambda *a: seen.append(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()) or make(*a))
    pipeline.build_all(spark, inputs, new_path(spark, "release"))
    assert seen == [1 << 18]


def test_locus_table_moves_no_row_twice(spark, tables, inputs):
    """Where tasks are named, the union of all parts is dealt out by locus already: the same rows, without an exchange above it."""
    tasks = summaries.locus_tasks(tables["v2d"], 1)
    parts = [tables["v2d"], summaries.locus_genes(tables["v2d"], tables["scores"], 1), tables["v2d_coloc"], inputs["l2g"]]
    found = summaries.manhattan(*parts, tasks=tasks)
    above = found._jdf.queryExecution().executedPlan().toString().split("Union")[0]
    assert tasks > 1 and "Aggregate" in above and "Exchange" not in above
    assert sorted(map(repr, found.collect())) == sorted(map(repr, summaries.manhattan(*parts).collect())) != []


def test_staged_tables_leave_no_shuffle_files(spark):
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(k).getPath() for k in range(found.size()) if "shuffle_" in found.apply(k).getName()}

    before = files()
    table = staged(spark.range(10_000).repartition(3, "id"), "some")
    assert not [f for f in files() - before if f.endswith(".data")]
    assert table.count() == 10_000
