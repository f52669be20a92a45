"""The operators applied to the star-schema tables, each with DuckDB SQL for the same rows.

Array results are joined to text and doubles rounded to six places, so that engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..functions import filters
from ..operators import aggregates, joins, layout, windows
from ..sources import io
from ..sources.shared import new_path, staged
from . import summaries, variant_disease, variant_gene

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return io.scan_parquet(spark, f"{sf_dir}/{name}.parquet")


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def joined(c: str) -> Column:
    return F.concat_ws(",", F.transform(c, lambda x: x.cast("string"))).alias(c)


def cents(c: str) -> Column:
    return F.concat_ws(",", F.transform(c, lambda x: F.round(x * 100).cast("long").cast("string"))).alias(c)


# scans and sinks


@query("scan_parquet", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double"


@query("scan_declared_schema", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def _(spark, d):
    return io.scan_declared(spark, f"{d}/orders.parquet", ORDERS)


PART = "p_partkey long, p_brand string, p_type string, p_retailprice double"
PART_SQL = "SELECT p_partkey, p_brand, p_type, p_retailprice FROM part"


def part(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_retailprice")


@query("scan_json", PART_SQL)
def _(spark, d):
    path = new_path(spark, "part-json")
    part(spark, d).write.option("compression", "gzip").json(path)
    return io.scan_json(spark, path, PART)


@query("scan_tsv", PART_SQL)
def _(spark, d):
    path = new_path(spark, "part-tsv")
    io.export_tsv(part(spark, d), path)
    return io.scan_tsv(spark, path, PART)


@query("scan_tsv_lookup", "SELECT p_partkey, p_brand, p_retailprice FROM part")
def _(spark, d):
    """Padded values, and a copy of each row with a key that is no number."""
    path = new_path(spark, "lookup-tsv")
    rows = part(spark, d).select(F.col("p_partkey").cast("string").alias("p_partkey"), F.concat(F.lit("  "), "p_brand", F.lit(" ")).alias("p_brand"), "p_retailprice")
    broken = rows.withColumn("p_partkey", F.concat(F.lit("no "), "p_partkey"))
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.unionByName(broken).write.options(**keep).csv(path, sep="\t", header=True)
    return io.scan_tsv_lookup(spark, path, "p_partkey long, p_brand string, p_retailprice double")


def roundtrip(fmt: str, max_records: int | None = None) -> Query:
    def run(spark, d):
        path, df = new_path(spark, f"orders-{fmt}"), io.scan_declared(spark, f"{d}/orders.parquet", ORDERS)
        io.write_table(df, path, fmt, max_records)
        return io.scan_declared(spark, path, df.schema, fmt)

    return run


query("roundtrip_parquet", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")(roundtrip("parquet", 1000))
query("roundtrip_json", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")(roundtrip("json"))


@query("roundtrip_tsv", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(spark, d):
    path, df = new_path(spark, "customer-tsv"), table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    io.export_tsv(df, path)
    return io.scan_tsv(spark, path, df.schema)


@query(
    "stringify_arrays",
    "SELECT p_brand, '[' || array_to_string(list_sort(list(DISTINCT p_type)), ',') || ']' AS types FROM part GROUP BY p_brand",
)
def _(spark, d):
    return C.stringify_arrays(aggregates.group_label_set(table(spark, d, "part"), ["p_brand"], "p_type", "types"))


# projections


def nested_orders(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", F.struct("o_orderstatus", F.struct("o_custkey", "o_totalprice").alias("who")).alias("body"))


@query("project_alias", "SELECT o_orderkey AS id, o_custkey AS customer, o_orderstatus AS status FROM orders")
def _(spark, d):
    return C.project_alias(nested_orders(spark, d), [("o_orderkey", "id"), ("body.who.o_custkey", "customer"), ("body.o_orderstatus", "status")])


@query("rename_columns", "SELECT n_nationkey AS KEY, n_name AS label, n_regionkey AS REGION FROM nation")
def _(spark, d):
    named = table(spark, d, "nation").withColumnsRenamed({"n_name": "label", "n_nationkey": "key", "n_regionkey": "region"})
    return C.rename_with(named, ["key", "region"], str.upper)


@query("flatten_structs", "SELECT o_orderkey, o_orderstatus, o_custkey, o_totalprice FROM orders")
def _(spark, d):
    return C.flatten_structs(C.flatten_structs(nested_orders(spark, d), ["body"]), ["who"])


@query(
    "conform_schema",
    "SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_name FROM customer",
)
def _(spark, d):
    return C.conform_schema(table(spark, d, "customer"), S.struct("c_custkey long, c_nationkey long, c_name string"), ["c_custkey"])


@query("compose_key", "SELECT c_custkey, concat_ws('_', nullif(c_nationkey, 3), c_custkey, c_mktsegment) AS key FROM customer")
def _(spark, d):
    key = C.compose_key(F.nullif("c_nationkey", F.lit(3)).cast("string"), F.col("c_custkey").cast("string"), "c_mktsegment")
    return table(spark, d, "customer").select("c_custkey", key.alias("key"))


@query(
    "split_key",
    "SELECT c_custkey, TRY_CAST(CASE WHEN c_nationkey = 3 THEN 'x' ELSE CAST(c_nationkey AS VARCHAR) END AS BIGINT) AS k_nation, "
    "c_custkey AS k_customer, c_mktsegment AS k_segment FROM customer",
)
def _(spark, d):
    nation = F.when(F.col("c_nationkey") == 3, "x").otherwise(F.col("c_nationkey").cast("string"))
    keyed = table(spark, d, "customer").select("c_custkey", C.compose_key(nation, F.col("c_custkey").cast("string"), "c_mktsegment").alias("key"))
    return C.split_key(keyed, "key", {"nation": "long", "customer": "long", "segment": "string"}, "k_").drop("key")


@query("pos_segment", "SELECT o_orderkey, CAST(trunc(o_totalprice / 10000) AS BIGINT) AS segment FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", C.pos_segment(F.col("o_totalprice"), 10_000).alias("segment"))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


@query(
    "category_ordinal",
    "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 0 END AS ordinal FROM orders",
)
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", C.category_ordinal(F.col("o_orderpriority"), PRIORITIES).alias("ordinal"))


@query(
    "path_tokens",
    "SELECT page_id, array_to_string(list_transform(list_filter(string_split(string_split(url, '//')[-1], '/'), lambda x: x <> '')[1:2], lambda x: lower(x)), '|') AS tokens FROM pages",
)
def _(spark, d):
    return table(spark, d, "pages").select("page_id", F.array_join(C.path_tokens(F.col("url"), "//"), "|").alias("tokens"))


@query("accession_tail", "SELECT page_id, string_split(regexp_replace(url, '/+$', ''), '/')[-1] AS tail FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", C.accession_tail(F.col("url")).alias("tail"))


@query(
    "zip_delimited",
    """SELECT p_partkey, array_to_string(list_transform(list_filter(range(1, greatest(len(a), len(b)) + 1), lambda i: coalesce(a[i], '') <> ''),
         lambda i: coalesce(a[i], '') || '=' || coalesce(b[i], '')), ',') AS pairs
       FROM (SELECT p_partkey, string_split(p_name, ' ') AS a, string_split(p_type || ' x y', ' ') AS b FROM part)""",
)
def _(spark, d):
    pairs = C.zip_delimited(F.replace("p_name", F.lit(" "), F.lit(";")), F.replace(F.concat("p_type", F.lit(" x y")), F.lit(" "), F.lit(";")))
    return table(spark, d, "part").select("p_partkey", F.array_join(F.transform(pairs, lambda p: F.array_join(p, "=")), ",").alias("pairs"))


@query("explode_structs", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def _(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_partkey", "l_quantity")).alias("lines"))
    return C.explode_structs(lines, "lines", ["l_partkey", "l_quantity"])


@query("blank_to_null", "SELECT doc_id, nullif(CASE WHEN lang = 'en' THEN '' ELSE lang END, '') AS lang FROM documents")
def _(spark, d):
    df = table(spark, d, "documents").select("doc_id", F.when(F.col("lang") == "en", "").otherwise(F.col("lang")).alias("lang"))
    return C.blank_to_null(df, ["lang"])


@query(
    "clean_arrays",
    "SELECT doc_id, array_to_string(list_filter([lang, '', source], lambda x: x <> ''), ',') AS tags FROM documents WHERE doc_id % 5 <> 0 UNION ALL SELECT doc_id, '' FROM documents WHERE doc_id % 5 = 0",
)
def _(spark, d):
    tags = F.when(F.col("doc_id") % 5 != 0, F.array("lang", F.lit(""), "source", F.lit(None).cast("string")))
    df = C.clean_arrays(table(spark, d, "documents").select("doc_id", tags.alias("tags")), ["tags"])
    return df.select("doc_id", joined("tags"))


@query("id_prefix", "SELECT c_custkey, regexp_extract(c_name, '^([a-zA-Z]+)(.*)', 1) AS prefix FROM customer")
def _(spark, d):
    return table(spark, d, "customer").select("c_custkey", C.id_prefix(F.col("c_name")).alias("prefix"))


@query(
    "clamped_pow10",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN e < -325 THEN log10(5e-324) WHEN log10(l_quantity) + e > 308.25471 THEN log10(1.7976931348623157e308)
              ELSE log10(l_quantity) + e END, 6) AS log_p
       FROM (SELECT *, CASE WHEN l_partkey % 2 = 0 THEN 307 + l_partkey % 100 ELSE -(l_partkey % 300) - CASE WHEN l_partkey % 300 > 290 THEN 100 ELSE 0 END END AS e FROM lineitem)""",
)
def _(spark, d):
    e = F.when(F.col("l_partkey") % 2 == 0, 307 + F.col("l_partkey") % 100).otherwise(
        -(F.col("l_partkey") % 300) - F.when(F.col("l_partkey") % 300 > 290, 100).otherwise(0)
    )
    p = C.clamped_pow10(F.col("l_quantity").cast("double"), e)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", r6(F.log10(p)).alias("log_p"))


@query(
    "neg_log10",
    "SELECT l_orderkey, l_linenumber, l_discount, round(-log10(CASE WHEN l_discount = 0 THEN 5e-324 ELSE l_discount END), 6) AS score FROM lineitem",
)
def _(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", r6(C.neg_log10(F.col("l_discount"))).alias("score"))


# filters


def holed_orders(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    return o.select(
        "o_orderkey",
        F.when(k % 3 != 0, F.col("o_custkey")).alias("a"),
        F.when(k % 5 != 0, F.col("o_orderstatus")).alias("b"),
        F.when(k % 7 == 0, float("nan")).when(k % 11 == 0, None).otherwise(F.col("o_totalprice")).alias("x"),
    )


HOLED = "(SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS a, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS b FROM orders)"


@query("filter_not_null", f"SELECT o_orderkey, a, b FROM {HOLED} WHERE a IS NOT NULL AND b IS NOT NULL")
def _(spark, d):
    return filters.not_null(holed_orders(spark, d), ["a", "b"]).select("o_orderkey", "a", "b")


@query("filter_any_evidence", f"SELECT o_orderkey, a, b FROM {HOLED} WHERE a IS NOT NULL OR b IS NOT NULL")
def _(spark, d):
    return filters.any_evidence(holed_orders(spark, d), ["a", "b"]).select("o_orderkey", "a", "b")


@query("filter_not_nan", "SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS x FROM orders WHERE o_orderkey % 7 <> 0")
def _(spark, d):
    return filters.not_nan(holed_orders(spark, d), "x").select("o_orderkey", "x")


@query("filter_in_not_in", "SELECT p_partkey, p_brand, p_size FROM part WHERE p_size IN (1, 5, 9, 13, 17) AND p_brand NOT IN ('Brand#11', 'Brand#12')")
def _(spark, d):
    return filters.in_not_in(table(spark, d, "part"), "p_size", [1, 5, 9, 13, 17], "p_brand", ["Brand#11", "Brand#12"]).select("p_partkey", "p_brand", "p_size")


@query(
    "filter_thresholds",
    """SELECT p.s_suppkey AS study, list_aggregate(list_transform(list_sort(list({'s': c, 'i': l_partkey}), 'DESC'), lambda x: CAST(x.i AS VARCHAR)), 'string_agg', ',') AS ids
       FROM (SELECT l_suppkey AS s_suppkey, l_partkey, max(1 - l_discount) AS c FROM lineitem
             WHERE round(1 - l_discount, 2) >= 0.95 AND log2(l_quantity) >= log2(5.0) AND l_returnflag <> 'R' GROUP BY ALL) p GROUP BY p.s_suppkey""",
)
def _(spark, d):
    li = table(spark, d, "lineitem")
    pairs = li.select(
        F.col("l_suppkey").alias("left_study"), F.lit("c").alias("left_chrom"), F.lit(1).alias("left_pos"), F.lit("A").alias("left_ref"), F.lit("T").alias("left_alt"),
        F.when(F.col("l_returnflag") == "R", "gwas").otherwise("eqtl").alias("right_type"), F.col("l_partkey").alias("right_gene_id"),
        (1 - F.col("l_discount")).alias("coloc_h4"), F.log2("l_quantity").alias("coloc_log2_h4_h3"),
    )
    return summaries.top_genes_coloc(pairs).select("study", joined("top10_genes_coloc_ids").alias("ids"))


@query("table_stats", "SELECT count(*) FILTER (event_type IN ('click', 'view')) AS known_rows, count(*) AS total_rows FROM events")
def _(spark, d):
    return filters.table_stats(table(spark, d, "events"), "event_type", ["click", "view"])


# joins


@query(
    "join_composite_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n FROM lineitem JOIN
       (SELECT l_partkey AS pk, l_suppkey AS sk, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1) ON l_partkey = pk AND l_suppkey = sk""",
)
def _(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    twice = li.groupBy(F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk")).agg(F.count("*").alias("n")).where("n > 1")
    return joins.join_composite_key(li, twice, {"l_partkey": "pk", "l_suppkey": "sk"})


@query("join_using", "SELECT o_orderkey, l_partkey, o_totalprice FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def _(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").join(lines, ["o_orderkey"])


@query(
    "left_join_defaults",
    """SELECT c_custkey, coalesce(n_orders, 0) AS n_orders, coalesce(segment, 'none') AS segment FROM customer LEFT JOIN
       (SELECT o_custkey AS c_custkey, count(*) AS n_orders, 'buyer' AS segment FROM orders GROUP BY o_custkey) USING (c_custkey)""",
)
def _(spark, d):
    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"), F.lit("buyer").alias("segment"))
    return joins.left_join_defaults(table(spark, d, "customer").select("c_custkey"), orders, ["c_custkey"], {"n_orders": 0, "segment": "none"})


@query("semi_join", "SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def _(spark, d):
    keys = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return joins.semi_join(table(spark, d, "part").select("p_partkey", "p_brand"), keys, ["p_partkey"])


@query(
    "full_outer_evidence",
    """SELECT l_partkey, a.n AS n_1995, b.n AS n_1996 FROM (SELECT l_partkey, count(*) AS n FROM lineitem WHERE year(l_shipdate) = 1995 GROUP BY 1) a
       FULL JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE year(l_shipdate) = 1996 GROUP BY 1) b USING (l_partkey)""",
)
def _(spark, d):
    li = table(spark, d, "lineitem")
    a, b = (li.where(F.year("l_shipdate") == y).groupBy("l_partkey").agg(F.count("*").alias(f"n_{y}")) for y in (1995, 1996))
    return joins.full_outer_evidence(a, b, ["l_partkey"])


@query(
    "null_or_match_join",
    """SELECT c_custkey, k FROM (SELECT c_custkey, nullif(c_nationkey, 0) AS k FROM customer)
       WHERE k IS NULL OR EXISTS (SELECT 1 FROM nation WHERE n_nationkey = k AND n_regionkey < 2)""",
)
def _(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.nullif("c_nationkey", F.lit(0)).alias("k"))
    return joins.null_or_match_join(c, table(spark, d, "nation").where("n_regionkey < 2"), {"k": "n_nationkey"}, "k")


def sides(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), "c_acctbal")
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), "s_acctbal")
    return c, s


BAND = "(SELECT c_custkey, s_suppkey, c_nationkey AS nation, abs(c_acctbal - s_acctbal) AS d, s_acctbal FROM customer JOIN supplier ON c_nationkey = s_nationkey AND abs(c_acctbal - s_acctbal) <= 1000)"


@query("band_join", f"SELECT c_custkey, s_suppkey, nation, round(d, 6) AS d FROM {BAND}")
def _(spark, d):
    c, s = sides(spark, d)
    return joins.band_join(c, s, ["nation"], "c_acctbal", "s_acctbal", 1000).select("c_custkey", "s_suppkey", "nation", r6("d").alias("d"))


INSIDE = """(SELECT a.user_id, a.s, a.e, a.v, b.event_id FROM
    (SELECT user_id, epoch_us(ts) AS s, epoch_us(ts) + 3600000000 AS e, max(value) AS v FROM events WHERE event_type = 'error' GROUP BY 1, 2, 3) a
    JOIN events b ON a.user_id = b.user_id AND b.event_type = 'click' AND epoch_us(b.ts) BETWEEN a.s AND a.e)"""
HOUR = 3_600_000_000


def error_hours(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    errors = e.where("event_type = 'error'").select("user_id", F.col("at").alias("start"), (F.col("at") + HOUR).alias("end"), F.col("value").alias("score"))
    clicks = e.where("event_type = 'click'").select("user_id", "event_id", "at")
    return aggregates.group_max(errors, ["user_id", "start", "end"], "score"), clicks


@query("interval_join", f"SELECT user_id, s, event_id FROM {INSIDE}")
def _(spark, d):
    hours, clicks = error_hours(spark, d)
    return joins.interval_join(hours, clicks, ["user_id"], "start", "end", "at", HOUR).select("user_id", F.col("start").alias("s"), "event_id")


@query(
    "interval_evidence",
    f"""SELECT user_id, event_id, round(v, 6) AS score, CASE WHEN v IS NOT NULL THEN round(percent_rank() OVER (ORDER BY v NULLS FIRST), 1) END AS q FROM {INSIDE}""",
)
def _(spark, d):
    hours, clicks = error_hours(spark, d)
    inside = joins.interval_join(hours, clicks, ["user_id"], "start", "end", "at", HOUR).withColumn("kind", F.lit("error"))
    inside = staged(inside, "inside")  # ranking reads it more than once
    return windows.percentile_by(inside, ["kind"], "score", "q", skew_safe=True).select("user_id", "event_id", r6("score").alias("score"), "q")


@query("argmin_by_group", f"SELECT c_custkey, round(d, 6) AS d, s_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) AS r FROM {BAND}) WHERE r = 1")
def _(spark, d):
    c, s = sides(spark, d)
    # the least distance lies next to a customer's own place, so no pairs are made
    near = joins.nearest_by(c, s, ["nation"], "c_acctbal", "s_acctbal", 1000, "s_suppkey", {"s_suppkey": None}).where("s_suppkey is not null")
    best = aggregates.argmin_by(near.withColumnRenamed("s_suppkey_distance", "d"), ["c_custkey"], "d", "s_suppkey")
    return best.select("c_custkey", r6("d").alias("d"), "s_suppkey")


@query(
    "nearest_by_distance",
    f"""WITH p AS (SELECT * FROM {BAND}),
        a AS (SELECT c_custkey, d, s_suppkey, row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) AS r FROM p),
        b AS (SELECT c_custkey, d, s_suppkey, row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) AS r FROM p WHERE s_acctbal > 0)
        SELECT c.c_custkey, round(a.d, 6) AS near_distance, a.s_suppkey AS near, round(b.d, 6) AS solvent_distance, b.s_suppkey AS solvent
        FROM customer c LEFT JOIN a ON a.c_custkey = c.c_custkey AND a.r = 1 LEFT JOIN b ON b.c_custkey = c.c_custkey AND b.r = 1""",
)
def _(spark, d):
    c, s = sides(spark, d)
    found = joins.nearest_by(c, s, ["nation"], "c_acctbal", "s_acctbal", 1000, "s_suppkey", {"near": None, "solvent": F.col("s_acctbal") > 0})
    return found.select("c_custkey", r6("near_distance").alias("near_distance"), "near", r6("solvent_distance").alias("solvent_distance"), "solvent")


@query(
    "distance_evidence",
    f"""SELECT c_custkey, s_suppkey, round(w, 6) AS distance_score, round(percent_rank() OVER (PARTITION BY nation ORDER BY w NULLS FIRST), 1) AS distance_score_q
        FROM (SELECT *, CASE WHEN d > 0 THEN 1.0 / d ELSE 1.0 END AS w FROM {BAND})""",
)
def _(spark, d):
    c, s = sides(spark, d)
    pairs = joins.band_join(c, s, ["nation"], "c_acctbal", "s_acctbal", 1000).withColumn("distance_score", C.inverse_distance(F.col("d")))
    # all pairs grow with the square of a nation's rows, so they are made again for each count instead of being kept
    ranked = windows.percentile_by_cuts(C.with_labels(pairs, source="balance"), ["nation"], "distance_score", "distance_score_q")
    return ranked.select("c_custkey", "s_suppkey", r6("distance_score").alias("distance_score"), "distance_score_q")


def flagship(spark, d):
    """Suppliers near each customer, scored and ranked in their nation; the best for each customer."""
    return QUERIES["distance_evidence"](spark, d)


@query(
    "stat_evidence",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(s, 6) AS score, round(percent_rank() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY s NULLS FIRST), 1) AS score_q
       FROM (SELECT *, -log10(CASE WHEN l_discount = 0 THEN 5e-324 ELSE l_discount END) AS s FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25))""",
)
def _(spark, d):
    li = table(spark, d, "lineitem").withColumn("score", C.neg_log10(F.col("l_discount")))
    keys = table(spark, d, "part").where("p_size > 25").select(F.col("p_partkey").alias("l_partkey"))
    known = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus", "score")
    known = staged(joins.semi_join(known, keys, ["l_partkey"]), "known")  # ranking reads it more than once
    ranked = windows.percentile_by(known, ["l_returnflag", "l_linestatus"], "score", "score_q")
    return ranked.select("l_orderkey", "l_linenumber", "l_partkey", r6("score").alias("score"), "score_q")


# windows

PERCENTILE = """SELECT l_orderkey, l_linenumber, l_returnflag, score, CASE WHEN score IS NOT NULL THEN round(percent_rank() OVER (PARTITION BY l_returnflag ORDER BY score NULLS FIRST), 1) END AS q
    FROM (SELECT *, CASE WHEN l_partkey % 11 <> 0 THEN l_extendedprice END AS score FROM lineitem)"""


def percentile(skew_safe: bool) -> Query:
    def run(spark, d):
        score = F.when(F.col("l_partkey") % 11 != 0, F.col("l_extendedprice")).alias("score")
        li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", score)
        return windows.percentile_by(li, ["l_returnflag"], "score", "q", skew_safe=skew_safe)

    return run


query("percentile_by_group", PERCENTILE)(percentile(False))
query("percentile_by_group_skewsafe", PERCENTILE)(percentile(True))


def top_sql(cut: str) -> str:
    return f"""SELECT s_nationkey, array_to_string(list_transform(l{cut}, lambda x: CAST(x.i AS VARCHAR)), ',') AS parts_ids,
        array_to_string(list_transform(l{cut}, lambda x: CAST(CAST(round(x.s * 100) AS BIGINT) AS VARCHAR)), ',') AS parts_score
        FROM (SELECT s_nationkey, list_sort(list({{'s': s, 'i': l_partkey}}), 'DESC') AS l
              FROM (SELECT s_nationkey, l_partkey, max(l_extendedprice) AS s FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL) GROUP BY s_nationkey)"""


def top_parts(n: int | None) -> Query:
    def run(spark, d):
        nations = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        lines = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_extendedprice").join(nations, "l_suppkey")
        top = windows.top_n_by_group(lines, ["s_nationkey"], "l_partkey", "l_extendedprice", "parts", n)
        return top.select("s_nationkey", joined("parts_ids"), cents("parts_score"))

    return run


query("top_n_by_group", top_sql(""))(top_parts(None))
query("top_n_by_group_capped", top_sql("[1:10]"))(top_parts(10))

# aggregates


@query("group_max", "SELECT l_partkey, l_suppkey, max(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY 1, 2")
def _(spark, d):
    return aggregates.group_max(table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"], "l_extendedprice")


@query("group_label_set", "SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds FROM events GROUP BY user_id")
def _(spark, d):
    return aggregates.group_label_set(table(spark, d, "events"), ["user_id"], "event_type", "kinds").select("user_id", joined("kinds"))


@query(
    "first_by_group",
    "SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1",
)
def _(spark, d):
    return aggregates.first_by_group(table(spark, d, "events"), ["user_id"], ["event_type", "value"], ["ts", "event_id"])


EVENT_SCORES = {"purchase": 3.0, "signup": 2.0, "click": 2.0}


@query(
    "label_score_max",
    """SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS kind_labels, min(CASE WHEN s = m THEN event_type END) AS kind_max_label, max(s) AS kind_max_score
       FROM (SELECT *, max(s) OVER (PARTITION BY user_id) AS m FROM (SELECT DISTINCT user_id, event_type,
             CASE event_type WHEN 'purchase' THEN 3.0 WHEN 'signup' THEN 2.0 WHEN 'click' THEN 2.0 ELSE 0.0 END::DOUBLE AS s FROM events))
       GROUP BY user_id HAVING max(s) > 0""",
)
def _(spark, d):
    lookup = io.inline_rows(spark, EVENT_SCORES, "event_type", "points")
    best = aggregates.label_score_max(table(spark, d, "events"), ["user_id"], "event_type", lookup, "points", "kind")
    return best.select("user_id", joined("kind_labels"), "kind_max_label", "kind_max_score")


EVENT_WEIGHTS = {"click": 0.66, "purchase": 1.0, "view": 0.33, "error": 0.33}
WEIGHTED = """SELECT user_id, round(sum(w * s) / 2.32, 6) AS overall_score, string_agg(event_type, ',' ORDER BY event_type) AS source_list,
    string_agg(CAST(CAST(round(s * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY event_type) AS source_score_list
    FROM (SELECT user_id, event_type, max(coalesce(value, 0)) + max(coalesce(CAST(user_id % 3 AS DOUBLE), 0)) AS s,
                 CASE event_type WHEN 'click' THEN 0.66 WHEN 'purchase' THEN 1.0 ELSE 0.33 END AS w
          FROM events WHERE event_type IN ('click', 'purchase', 'view', 'error') GROUP BY 1, 2) GROUP BY user_id"""


@query("weighted_source_score", WEIGHTED)
def _(spark, d):
    e = table(spark, d, "events").withColumn("extra", (F.col("user_id") % 3).cast("double"))
    scores = aggregates.weighted_source_score(e, ["user_id"], "event_type", ["value", "extra"], EVENT_WEIGHTS)
    return scores.select("user_id", r6("overall_score").alias("overall_score"), joined("source_list"), cents("source_score_list"))


@query(
    "conditional_distinct_counts",
    """SELECT o_custkey, min(o_orderdate) AS first_order, count(DISTINCT l_partkey) AS parts, count(DISTINCT CASE WHEN l_discount > 0.05 THEN l_partkey END) AS discounted,
       count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS returned FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey""",
)
def _(spark, d):
    lines = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey").join(table(spark, d, "orders"), "o_orderkey")
    counts = {"parts": None, "discounted": F.col("l_discount") > 0.05, "returned": F.col("l_returnflag") == "R"}
    return aggregates.conditional_distinct(lines, ["o_custkey"], F.col("l_partkey"), counts, {"first_order": F.col("o_orderdate")})


@query(
    "union_evidence",
    """SELECT event_id, value AS click_value, NULL::DOUBLE AS buy_value, '' AS tags FROM events WHERE event_type = 'click'
       UNION ALL SELECT event_id, NULL, value, event_type || ',' || user_id FROM events WHERE event_type = 'purchase'
       UNION ALL SELECT event_id, NULL, NULL, '' FROM events WHERE event_type = 'view'""",
)
def _(spark, d):
    e = table(spark, d, "events")
    clicks = e.where("event_type = 'click'").select("event_id", F.col("value").alias("click_value"))
    buys = e.where("event_type = 'purchase'").select("event_id", F.col("value").alias("buy_value"), F.array("event_type", F.col("user_id").cast("string")).alias("tags"))
    whole = joins.union_evidence(clicks, buys, e.where("event_type = 'view'").select("event_id"), array_defaults=["tags"], columns=["event_id", "click_value", "buy_value", "tags"])
    return whole.select("event_id", "click_value", "buy_value", joined("tags"))


# layout


@query("global_sort", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, d):
    return layout.global_sort(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"])


@query("cluster_by_position", "SELECT l_returnflag, l_partkey, l_orderkey FROM lineitem")
def _(spark, d):
    return layout.cluster_by_position(table(spark, d, "lineitem").select("l_returnflag", "l_partkey", "l_orderkey"), "l_returnflag", "l_partkey")


@query("cluster_by_each", "SELECT l_suppkey, l_returnflag, l_partkey, l_orderkey FROM lineitem")
def _(spark, d):
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", "l_partkey", "l_orderkey")
    return layout.cluster_by_each(lines, [["l_suppkey"], ["l_returnflag", "l_partkey"]])


# tables: parts as variants, suppliers as genes, orders as studies, their first line as lead variant


def as_genes(spark, d):
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(
        F.when(k % 13 == 0, "MT").otherwise(F.concat(F.lit("c"), (k % 5).cast("string"))).alias("chr"),
        F.concat(F.lit("S"), k.cast("string")).alias("gene_id"),
        F.col("s_name").alias("gene_name"),
        F.lit(True).alias("fwdstrand"),
        F.lit(None).cast("long").alias("tss"),
        (k * 7).alias("start"),
        (k * 7 + 3).alias("end"),
        F.when(k % 3 == 0, "protein_coding").when(k % 3 == 1, "lincRNA").otherwise("pseudogene").alias("biotype"),
    )


GENES = """SELECT * FROM (SELECT 'S' || s_suppkey AS gene_id, s_name AS gene_name, CASE WHEN s_suppkey % 13 = 0 THEN 'MT' ELSE 'c' || s_suppkey % 5 END AS chr, s_suppkey * 7 AS tss,
    CASE s_suppkey % 3 WHEN 0 THEN 'protein_coding' WHEN 1 THEN 'lincRNA' ELSE 'pseudogene' END AS biotype FROM supplier) WHERE chr <> 'MT' AND biotype <> 'pseudogene'"""


@query("gene_index", f"SELECT gene_id, gene_name, chr, tss, biotype FROM ({GENES})")
def _(spark, d):
    return variant_gene.gene_index(as_genes(spark, d)).select("gene_id", "gene_name", "chr", "tss", "biotype")


def as_variants(spark, d, least: int = 10):
    k = F.col("p_partkey")
    return table(spark, d, "part").where(F.col("p_size") > least).select(
        F.concat(F.lit("c"), (k % 5).cast("string")).alias("chr_id"), k.alias("position"), F.lit("A").alias("ref_allele"), F.lit("T").alias("alt_allele"),
        F.col("p_name").alias("rs_id"),
    )


def as_studies(spark, d):
    k = F.col("o_orderkey")
    key = k.cast("string")
    return table(spark, d, "orders").select(
        F.concat(F.when(k % 5 == 0, "").otherwise(F.lit("ST")), F.lit("_"), key).alias("study_id"),
        F.when(k % 10 == 0, "").otherwise(F.col("o_orderpriority")).alias("trait_reported"),
        F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("P"), key)).alias("pmid"),
        F.lit("2020").alias("pub_date"), F.lit("").alias("pub_journal"), F.lit("t").alias("pub_title"), F.lit("a").alias("pub_author"), F.lit(True).alias("has_sumstats"),
        F.array(F.lit(""), F.col("o_orderstatus")).alias("ancestry_initial"), F.lit(None).cast("array<string>").alias("ancestry_replication"),
        k.alias("n_initial"), F.lit(None).cast("long").alias("n_replication"), F.lit(None).cast("long").alias("n_cases"), F.lit(1).cast("long").alias("num_assoc_loci"),
    )


def as_traits(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").where("o_orderstatus <> 'O'").select(
        F.concat(F.when(k % 5 == 0, "").otherwise(F.lit("ST")), F.lit("_"), k.cast("string")).alias("study_id"),
        F.array("o_orderpriority").alias("trait_efos"), F.col("o_orderstatus").alias("trait_category"),
    )


STUDY_ID = "CASE WHEN {k} % 5 = 0 THEN '' ELSE 'ST' END || '_' || {k}"
STUDIES = f"""SELECT {STUDY_ID.format(k='o_orderkey')} AS study_id, o_orderpriority AS trait_reported, CASE WHEN o_orderkey % 3 <> 0 THEN 'P' || o_orderkey END AS pmid,
    CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'ST' END AS source, CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus ELSE 'Uncategorised' END AS trait_category,
    CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority ELSE '' END AS efos, o_orderstatus AS ancestry FROM orders WHERE o_orderkey % 10 <> 0"""


def studies(spark, d):
    return variant_disease.study_index(as_studies(spark, d), as_traits(spark, d))


@query("study_index", STUDIES)
def _(spark, d):
    return studies(spark, d).select("study_id", "trait_reported", "pmid", "source", "trait_category", joined("trait_efos").alias("efos"), joined("ancestry_initial").alias("ancestry"))


@query(
    "search_tables",
    f"""SELECT 'variant' AS kind, 'c' || p_partkey % 5 || '_' || p_partkey || '_A_T' AS id, p_name AS name FROM part WHERE p_size > 10
        UNION ALL SELECT 'gene', gene_id, gene_name FROM ({GENES}) UNION ALL SELECT 'study', study_id, trait_reported FROM ({STUDIES})""",
)
def _(spark, d):
    found = summaries.search_tables(as_variants(spark, d), studies(spark, d), variant_gene.gene_index(as_genes(spark, d)))
    columns = {"variant": ("variant_id", "rs_id"), "gene": ("gene_id", "gene_name"), "study": ("study_id", "trait_reported")}
    parts = [found[k].select(F.lit(k).alias("kind"), F.col(a).alias("id"), F.col(b).alias("name")) for k, (a, b) in columns.items()]
    return joins.union_evidence(*parts)


@query(
    "variant_nearest_gene",
    f"""WITH g AS ({GENES}), p AS (SELECT p_partkey, gene_id, biotype, abs(p_partkey - tss) AS d FROM part JOIN g ON chr = 'c' || p_partkey % 5 AND abs(p_partkey - tss) <= 100),
        a AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY d, gene_id) AS r FROM p),
        b AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY d, gene_id) AS r FROM p WHERE biotype = 'protein_coding')
        SELECT p_partkey AS position, a.d AS gene_id_any_distance, a.gene_id AS gene_id_any, b.d AS gene_id_prot_coding_distance, b.gene_id AS gene_id_prot_coding
        FROM part LEFT JOIN (FROM a WHERE r = 1) a USING (p_partkey) LEFT JOIN (FROM b WHERE r = 1) b USING (p_partkey)""",
)
def _(spark, d):
    raw = as_variants(spark, d, 0).select(
        F.lit(None).cast("string").alias("chrom_b37"), F.lit(None).cast("long").alias("pos_b37"), F.col("chr_id").alias("chrom_b38"), F.col("position").alias("pos_b38"),
        F.col("ref_allele").alias("ref"), F.col("alt_allele").alias("alt"), F.col("rs_id").alias("rsid"), F.struct(F.lit("x").alias("most_severe_consequence")).alias("vep"),
        F.struct(F.lit(0.0).alias("raw")).alias("cadd"), F.struct(F.lit(0.0).alias("gnomad_afr")).alias("af"),
    )
    genes = as_genes(spark, d).withColumn("tss", F.col("start"))
    found = variant_gene.variant_index(raw, genes, 100)
    return found.select("position", "gene_id_any_distance", "gene_id_any", "gene_id_prot_coding_distance", "gene_id_prot_coding")


def lead() -> list[Column]:
    k = F.col("lead_part")
    return [F.concat(F.lit("c"), (k % 5).cast("string")).alias("lead_chrom"), k.alias("lead_pos"), F.lit("A").alias("lead_ref"), F.lit("T").alias("lead_alt")]


def study_key(k: str) -> Column:
    return F.concat(F.when(F.col(k) % 5 == 0, "").otherwise(F.lit("ST")), F.lit("_"), F.col(k).cast("string")).alias("study_id")


#: Order lines for each task, where tasks go by counted rows.
LINES = 250_000


def dealt(df: DataFrame, lines: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys`` to as many tasks as the counted ``lines`` ask for, so that a task's memory stays when the table grows."""
    return df.repartition(1 + lines.count() // LINES, *keys)


def firsts(spark, d):
    """One lead part for each order."""
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("lead_part"), F.max("l_quantity").cast("double").alias("m"), F.max("l_suppkey").alias("e"))


def as_loci(spark, d):
    chrom = F.concat(F.lit("c"), (F.col("lead_part") % 5).cast("string"))
    return firsts(spark, d).select(
        study_key("l_orderkey"), chrom.alias("chrom"), F.col("lead_part").alias("pos"), F.lit("A").alias("ref"), F.lit("T").alias("alt"), F.lit("+").alias("direction"),
        *[F.lit(None).cast("double").alias(c) for c in ("beta", "beta_ci_lower", "beta_ci_upper", "odds_ratio", "oddsr_ci_lower", "oddsr_ci_upper")],
        F.col("m").alias("pval_mantissa"), (-(F.col("e") % 20)).cast("long").alias("pval_exponent"),
    )


def as_tags(spark, d, rows: str, value: str, name: str):
    k = F.col("l_partkey")
    # dealt by order at once, as the grouping keeps that for the join; hardly a line shares its order and part with another
    tags = table(spark, d, "lineitem").where(rows).select("l_orderkey", "l_partkey", value).repartition("l_orderkey")
    best = tags.groupBy("l_orderkey", "l_partkey").agg(F.max(value).alias(name)).join(firsts(spark, d), "l_orderkey")
    tag = [F.concat(F.lit("c"), (k % 5).cast("string")).alias("tag_chrom"), k.alias("tag_pos"), F.lit("A").alias("tag_ref"), F.lit("T").alias("tag_alt")]
    return best.select(study_key("l_orderkey"), *lead(), *tag, name)


def v2d(spark, d):
    ld, fm = as_tags(spark, d, "l_returnflag <> 'R'", "l_discount", "overall_r2"), as_tags(spark, d, "l_linestatus = 'F'", "l_tax", "posterior_prob")
    return variant_disease.variant_disease(as_variants(spark, d), studies(spark, d), variant_disease.top_loci(as_loci(spark, d), cluster=False), ld, fm)


V2D = f"""SELECT s.study_id, f.lead_part, t.l_partkey AS tag_part, r2, pp, m, e FROM ({STUDIES}) s
    JOIN (SELECT {STUDY_ID.format(k='l_orderkey')} AS study_id, l_orderkey, min(l_partkey) AS lead_part, max(l_quantity) AS m, -(max(l_suppkey) % 20) AS e
          FROM lineitem GROUP BY l_orderkey) f USING (study_id)
    JOIN (SELECT l_orderkey, l_partkey, max(l_discount) FILTER (l_returnflag <> 'R') AS r2, max(l_tax) FILTER (l_linestatus = 'F') AS pp
          FROM lineitem WHERE l_returnflag <> 'R' OR l_linestatus = 'F' GROUP BY 1, 2) t USING (l_orderkey)
    JOIN part ON p_partkey = t.l_partkey AND p_size > 10"""


@query("variant_disease", f"SELECT study_id, lead_part AS lead_pos, tag_part AS tag_pos, r2 AS overall_r2, pp AS posterior_prob, e AS pval_exponent FROM ({V2D})")
def _(spark, d):
    return v2d(spark, d).select("study_id", "lead_pos", "tag_pos", "overall_r2", "posterior_prob", "pval_exponent")


SOURCES = ["vep", "eqtl", "canonical_tss", "unknown"]


def v2g(spark, d):
    k, g = F.col("l_partkey"), F.col("l_suppkey")
    pairs = table(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.max("l_discount").alias("qtl_score_q"), F.max("l_tax").alias("distance_score_q"))
    evidence = pairs.select(
        F.concat(F.lit("c"), (k % 5).cast("string")).alias("chr_id"), k.alias("position"), F.lit("A").alias("ref_allele"), F.lit("T").alias("alt_allele"),
        F.concat(F.lit("S"), g.cast("string")).alias("gene_id"), F.lit("f").alias("feature"), F.lit("t").alias("type_id"),
        F.get(F.array(*map(F.lit, SOURCES)), (g % 4).cast("int")).alias("source_id"), "qtl_score_q", "distance_score_q",
    )
    by_source = [evidence.where(F.col("source_id") == "vep").drop("qtl_score_q"), evidence.where(F.col("source_id") != "vep")]
    return variant_gene.variant_gene(by_source, variant_gene.gene_index(as_genes(spark, d)))


V2G = f"""SELECT l_partkey AS pos, 'S' || l_suppkey AS gene_id, ['vep', 'eqtl', 'canonical_tss', 'unknown'][l_suppkey % 4 + 1] AS source_id,
    CASE WHEN l_suppkey % 4 <> 0 THEN q END AS qtl_score_q, t AS distance_score_q
    FROM (SELECT l_partkey, l_suppkey, max(l_discount) AS q, max(l_tax) AS t FROM lineitem GROUP BY 1, 2) WHERE 'S' || l_suppkey IN (SELECT gene_id FROM ({GENES}))"""


@query("variant_gene", V2G)
def _(spark, d):
    return v2g(spark, d).select(F.col("position").alias("pos"), "gene_id", "source_id", "qtl_score_q", "distance_score_q")


D2V2G = f"""SELECT d.study_id, d.lead_part, d.tag_part, g.gene_id, g.source_id, g.qtl_score_q, g.distance_score_q FROM ({V2D}) d JOIN ({V2G}) g ON d.tag_part = g.pos WHERE r2 IS NOT NULL OR pp IS NOT NULL"""


@query("disease_variant_gene", f"SELECT study_id, lead_part AS lead_pos, tag_part AS tag_pos, gene_id, source_id FROM ({D2V2G})")
def _(spark, d):
    return variant_disease.disease_variant_gene(v2d(spark, d), v2g(spark, d)).select("study_id", "lead_pos", "tag_pos", "gene_id", "source_id")


SCORES = f"""SELECT pos, gene_id, sum(w * s) / 4.97 AS overall_score, string_agg(source_id, ',') AS source_list FROM (SELECT pos, gene_id, source_id,
    max(coalesce(qtl_score_q, 0)) + max(distance_score_q) AS s, CASE source_id WHEN 'vep' THEN 1.0 WHEN 'eqtl' THEN 0.66 ELSE 0.33 END AS w
    FROM ({V2G}) WHERE source_id <> 'unknown' GROUP BY 1, 2, 3) GROUP BY 1, 2"""


def scorable(spark, d):
    """The columns of v2g that scores are made of, written once for their several readers."""
    return staged(v2g(spark, d).select(*S.VARIANT_KEY, "gene_id", "source_id", *S.EVIDENCE_SCORES), "v2g")


@query(
    "scored_datasets",
    f"""SELECT 'v2g' AS kind, g.pos, g.gene_id, '' AS study_id, round(overall_score, 6) AS overall_score, source_list FROM ({V2G}) g JOIN ({SCORES}) s ON g.pos = s.pos AND g.gene_id = s.gene_id
        UNION ALL SELECT 'd2v2g', tag_part, d.gene_id, study_id, round(overall_score, 6), source_list FROM ({D2V2G}) d JOIN ({SCORES}) s ON d.tag_part = s.pos AND d.gene_id = s.gene_id""",
)
def _(spark, d):
    genes = scorable(spark, d)
    disease, columns = v2d(spark, d), [*S.VARIANT_KEY, "gene_id", r6("overall_score").alias("overall_score"), joined("source_list")]
    scores = staged(variant_gene.evidence_scores(genes).select(*columns), "scores")
    a = summaries.scored_datasets(genes, variant_disease.disease_variant_gene(disease, genes), scores=scores)[0]
    b = summaries.scored_disease(disease, genes, scores)
    return a.select(F.lit("v2g").alias("kind"), F.col("position").alias("pos"), "gene_id", F.lit("").alias("study_id"), "overall_score", "source_list").union(
        b.select(F.lit("d2v2g"), "tag_pos", "gene_id", "study_id", "overall_score", "source_list")
    )


def as_coloc(spark, d):
    k, g = F.col("l_orderkey"), F.col("l_suppkey")
    lines = table(spark, d, "lineitem")
    best = dealt(lines, lines, "l_orderkey").join(firsts(spark, d), "l_orderkey")
    return best.groupBy("l_orderkey", "lead_part", "l_suppkey", "l_partkey").agg(F.max("l_discount").alias("x")).select(
        study_key("l_orderkey").alias("left_study"), F.concat(F.lit("c"), (F.col("lead_part") % 5).cast("string")).alias("left_chrom"), F.col("lead_part").alias("left_pos"),
        F.lit("A").alias("left_ref"), F.lit("T").alias("left_alt"), F.lit("eqtl").alias("right_type"),
        F.concat(F.lit("c"), (F.col("l_partkey") % 5).cast("string")).alias("right_chrom"), F.col("l_partkey").alias("right_pos"),
        F.lit("A").alias("right_ref"), F.lit("T").alias("right_alt"), F.when(g % 6 != 0, F.concat(F.lit("S"), g.cast("string"))).alias("right_gene_id"),
        F.when(k % 4 == 0, float("nan")).when(k % 7 == 0, None).otherwise(F.col("x")).alias("coloc_h3"), (1 - F.col("x")).alias("coloc_h4"), F.lit(3.0).alias("coloc_log2_h4_h3"),
    )


def coloc(spark, d):
    return variant_disease.coloc_index(as_coloc(spark, d), variant_gene.gene_index(as_genes(spark, d)), as_variants(spark, d))


COLOC = f"""SELECT * FROM (SELECT {STUDY_ID.format(k='l_orderkey')} AS left_study, lead_part, l_partkey, CASE WHEN l_suppkey % 6 <> 0 THEN 'S' || l_suppkey END AS gene, 1 - max(l_discount) AS h4
    FROM lineitem JOIN (SELECT l_orderkey, min(l_partkey) AS lead_part FROM lineitem GROUP BY 1) USING (l_orderkey)
    WHERE l_orderkey % 4 <> 0 GROUP BY l_orderkey, lead_part, l_suppkey, l_partkey) c
    WHERE (gene IS NULL OR EXISTS (SELECT 1 FROM ({GENES}) g WHERE g.gene_id = gene AND g.chr = 'c' || lead_part % 5)) AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10)"""


@query("coloc_index", f"SELECT left_study, lead_part AS left_pos, l_partkey AS right_pos, gene AS right_gene_id, round(h4, 6) AS coloc_h4 FROM ({COLOC})")
def _(spark, d):
    return coloc(spark, d).select("left_study", "left_pos", "right_pos", "right_gene_id", r6("coloc_h4").alias("coloc_h4"))


def twice(disease: DataFrame) -> DataFrame:
    """Some loci stand twice, the second time with another effect: better by an order of magnitude at odd positions, else worse."""
    odd = F.col("lead_pos") % 2
    other = {
        "pval": F.col("pval") * F.when(odd == 1, 0.1).otherwise(10.0), "pval_exponent": F.col("pval_exponent") + F.when(odd == 1, -1).otherwise(1),
        "beta": F.lit(0.25), "direction": F.lit("-"),
    }
    return disease.unionByName(disease.where("lead_pos % 7 = 0").withColumns({c: v.cast(disease.schema[c].dataType) for c, v in other.items()}))


@query(
    "locus_summary_star",
    f"""WITH d AS (SELECT *, '+' AS dir, NULL::DOUBLE AS beta FROM ({V2D}) UNION ALL SELECT * REPLACE (e + CASE lead_part % 2 WHEN 1 THEN -1 ELSE 1 END AS e), '-', 0.25 FROM ({V2D}) WHERE lead_part % 7 = 0),
        f AS (SELECT * FROM (SELECT study_id, lead_part, m, e, dir, beta, row_number() OVER (PARTITION BY study_id, lead_part ORDER BY e) AS r FROM d) WHERE r = 1),
        v AS (SELECT study_id, lead_part, count(DISTINCT CASE WHEN pp > 0 THEN tag_part END) AS credible, count(DISTINCT CASE WHEN r2 > 0 THEN tag_part END) AS ld,
            count(DISTINCT tag_part) AS uniq FROM d GROUP BY 1, 2),
        r AS (SELECT study_id, lead_part, count(DISTINCT d.gene_id) AS n FROM ({D2V2G}) d JOIN ({SCORES}) s ON d.tag_part = s.pos AND d.gene_id = s.gene_id GROUP BY 1, 2),
        c AS (SELECT left_study, lead_part FROM ({COLOC}) WHERE round(h4, 2) >= 0.95 GROUP BY 1, 2)
        SELECT v.study_id AS study, v.lead_part AS pos, m AS pval_mantissa, e AS pval_exponent, dir AS direction, beta, credible AS "credibleSetSize", ld AS "ldSetSize", uniq AS uniq_variants,
            coalesce(r.n, -1) AS n_raw, c.left_study IS NOT NULL AS has_coloc
        FROM v JOIN f USING (study_id, lead_part) LEFT JOIN r USING (study_id, lead_part) LEFT JOIN c ON c.left_study = v.study_id AND c.lead_part = v.lead_part""",
)
def _(spark, d):
    columns = [*S.LEAD_KEY, *S.TAG_KEY, "overall_r2", "posterior_prob", *summaries.EFFECTS.values()]
    disease, genes = staged(twice(v2d(spark, d).select(*columns)), "v2d"), scorable(spark, d)
    # both gene lists ask for a gene's best score in a locus alone, so variants that stand twice need not be told apart
    scores = variant_gene.evidence_scores(genes)
    scored = summaries.locus_genes(disease, scores)
    best = summaries.locus_genes(disease, scores.where(F.col("overall_score") >= S.MIN_PROBABILITY))
    l2g = best.withColumnsRenamed({c: k for k, c in zip(S.LOCUS_KEY[1:], S.LEAD_KEY[1:], strict=True)}).withColumnRenamed("overall_score", "y_proba_full_model")
    whole = summaries.manhattan(disease, scored, coloc(spark, d), l2g, tasks=summaries.locus_tasks(disease))
    return whole.select(
        "study", "pos", "pval_mantissa", "pval_exponent", "direction", "beta", "credibleSetSize", "ldSetSize", "uniq_variants",
        F.coalesce(F.size("top10_genes_raw_ids"), F.lit(-1)).cast("long").alias("n_raw"), F.col("top10_genes_coloc_ids").isNotNull().alias("has_coloc"),
    )
