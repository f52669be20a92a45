"""All tables in dependency order, each written and read back with its schema; a release that failed goes on where it stopped."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .. import schemas as S
from ..sources import io
from ..sources.shared import new_path, scratch
from . import summaries, variant_disease, variant_gene

MAX_RECORDS = 1_000_000
#: Goes into every table's fingerprint: raise it when a table's meaning changes.
VERSION = "3"


def digest(*parts: str) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


class Release:
    """Tables under one folder, each with a note of what it was made from.

    A table is written aside and renamed when it is whole, then noted: its fingerprint is that of its inputs, options and
    VERSION. A table whose note has the same fingerprint is taken as it is. One with another note, or without, is never overwritten.
    """

    def __init__(self, spark: SparkSession, inputs: Mapping[str, DataFrame], out: str, options: str = "") -> None:
        self.spark, self.inputs, self.out, self.options = spark, inputs, out, options
        self.tables: dict[str, DataFrame] = {}
        self.prints: dict[str, str] = {}
        self.made: list[str] = []
        self.files = spark._jvm.org.apache.hadoop.fs.Path(out).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.out, *parts]))

    def of_input(self, df: DataFrame) -> str:
        """Files with sizes and times, and what is done to them. Rows that come from no file have the hash of their plan: another session's differ."""
        stats = []
        for name in sorted(df.inputFiles()):
            s = self.files.getFileStatus(self.spark._jvm.org.apache.hadoop.fs.Path(name))
            stats.append(f"{name} {s.getLen()} {s.getModificationTime()}")
        return digest(df.schema.json(), str(df.semanticHash()), *stats)

    def of(self, name: str) -> str:
        if name not in self.prints:
            self.prints[name] = self.of_input(self.inputs[name])
        return self.prints[name]

    def note(self, name: str) -> dict | None:
        place = self.path("_notes", f"{name.replace('/', '.')}.json")
        if not self.files.exists(place):
            return None
        with_lines = self.spark.read.text(place.toString(), wholetext=True)
        return json.loads(with_lines.first()["value"])

    def write_note(self, name: str, note: dict) -> None:
        stream = self.files.create(self.path("_notes", f"{name.replace('/', '.')}.json"), True)
        stream.write(bytearray(json.dumps(note).encode()))
        stream.close()

    def keep(
        self, name: str, needs: Sequence[str], make: Callable[[], DataFrame], fmt: str, max_records: int | None = None,
        keys: Sequence[str] | None = None, buckets: int | None = None, ordered: bool = True,
    ) -> DataFrame:
        """The table ``name``, made from ``needs`` (inputs and earlier tables) unless it is there; in buckets by ``keys`` if ``buckets`` is given,
        sorted by them if ``ordered``."""
        keys = keys if buckets else None
        own = digest(VERSION, name, fmt, str(max_records), str(keys), str(buckets), self.options, *[self.of(n) for n in needs])
        note, place = self.note(name), self.path(name)
        if note is None or note["fingerprint"] != own:
            if self.files.exists(place):
                raise ValueError(f"{place.toString()} exists and was made from something else")
            with scratch(self.spark):  # what the operators stage for this table
                df = make()
                aside = new_path(self.spark, f"building-{name.replace('/', '.')}")
                if keys:
                    io.write_bucketed(df, aside, keys, buckets, ordered)
                else:
                    io.write_table(df, aside, fmt, max_records)
            self.files.mkdirs(place.getParent())
            if not self.files.rename(self.spark._jvm.org.apache.hadoop.fs.Path(aside), place):
                raise OSError(f"cannot move {aside} to {place.toString()}")
            note = {"fingerprint": own, "schema": df.schema.json()}
            self.write_note(name, note)
            self.made.append(name)
        schema = StructType.fromJson(json.loads(note["schema"]))
        self.prints[name] = own
        path = place.toString()
        self.tables[name] = io.scan_bucketed(self.spark, path, schema, keys, buckets, ordered) if keys else io.scan_declared(self.spark, path, schema, fmt)
        return self.tables[name]


def build_all(
    spark: SparkSession, inputs: Mapping[str, DataFrame], out: str, fmt: str = "parquet", weights: Mapping[str, float] = S.SOURCE_WEIGHTS, buckets: int | None = None
) -> dict[str, DataFrame]:
    """Build every table under ``out`` from the raw inputs.

    inputs: raw_variants, genes, consequence_scores, qtl, intervals (with filename), studies,
    traits, toploci, ld, finemapping, overlaps, coloc, l2g. Each table is written once and later
    steps read the written one, so no step is computed twice and lineage stays short. After a failure the same
    call goes on: whole tables are kept, and tables that operators staged are removed (Release). ``out`` and the session's
    shared folder lie on one file system. What is sent to every task is bounded by rows, not by compressed files (io.broadcast_by_rows).

    buckets: the tables that are joined by variant (v2g, v2d, scores, d2v2g) are written in so many buckets by variant key, as Parquet,
    so that their joins move none of them. d2v2g, a product of many rows a variant, is written as its join makes it, and no later step reads it or its
    scored copy: both are made from v2d and v2g, whose rows are few.
    """
    release = Release(spark, inputs, out, json.dumps(sorted(weights.items())))

    def keep(
        name: str, needs: str, make: Callable[[], DataFrame], kind: str = fmt, max_records: int | None = None, keys: Sequence[str] | None = None, ordered: bool = True
    ) -> DataFrame:
        return release.keep(name, needs.split(), make, kind, max_records, keys, buckets, ordered)

    with io.broadcast_by_rows(spark):
        genes = variant_gene.gene_index(inputs["genes"])
        variants = keep("variant-index", "raw_variants genes", lambda: variant_gene.variant_index(inputs["raw_variants"], inputs["genes"]), "parquet")
        studies = keep("lut/study-index", "studies traits", lambda: variant_disease.study_index(inputs["studies"], inputs["traits"]))
        luts = summaries.dictionaries(variants, inputs["studies"], inputs["traits"], inputs["overlaps"], inputs["genes"])
        for name, needs in {"variant-index": "variant-index", "overlap-index": "overlaps", "genes-index": "genes"}.items():
            keep(f"lut/{name}", needs, lambda name=name: luts[name])
        searches = summaries.search_tables(variants, studies, genes)
        for name, needs in {"variant": "variant-index", "study": "lut/study-index", "gene": "genes"}.items():
            keep(f"search/{name}", needs, lambda name=name: searches[name], "json")
        coloc = keep("v2d_coloc", "coloc genes variant-index", lambda: variant_disease.coloc_index(inputs["coloc"], genes, variants))
        v2d = keep(
            "v2d", "variant-index lut/study-index toploci ld finemapping",
            lambda: variant_disease.variant_disease(variants, studies, variant_disease.top_loci(inputs["toploci"], cluster=False), inputs["ld"], inputs["finemapping"]), keys=S.TAG_KEY,
        )

        def evidence() -> DataFrame:
            parts = [
                variant_gene.consequence_evidence(inputs["raw_variants"], inputs["consequence_scores"]),
                variant_gene.distance_evidence(variants, genes),
                variant_gene.qtl_evidence(inputs["qtl"], variants),
                variant_gene.interval_evidence(inputs["intervals"], variants),
            ]
            return variant_gene.variant_gene(parts, genes)

        with io.joined_in_buckets(spark):
            v2g = keep("v2g", "raw_variants consequence_scores variant-index genes qtl intervals", evidence, keys=S.VARIANT_KEY)
            scores = keep("scores", "v2g", lambda: variant_gene.evidence_scores(v2g, weights), "parquet", keys=S.VARIANT_KEY)
            d2v2g = keep("d2v2g", "v2d v2g", lambda: variant_disease.disease_variant_gene(v2d, v2g), keys=S.TAG_KEY, ordered=False)
            v2g_scored, joined = summaries.scored_datasets(v2g, d2v2g, weights, scores)
            keep("v2g_scored", "v2g scores", lambda: v2g_scored, max_records=MAX_RECORDS)
            keep("d2v2g_scored", "v2d v2g scores", lambda: summaries.scored_disease(v2d, v2g, scores).select(*joined.columns), max_records=MAX_RECORDS)
        keep("manhattan", "v2d scores v2d_coloc l2g", lambda: summaries.manhattan(v2d, summaries.locus_genes(v2d, scores), coloc, inputs["l2g"], tasks=summaries.locus_tasks(v2d)))
    return release.tables
