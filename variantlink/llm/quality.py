"""Quality rules by compression bands (operator 2)."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (bytes below, least and most raw/compressed ratio); prose of many languages lies well inside.
BANDS = ((256, 0.5, 2.8), (1024, 1.05, 3.2), (4096, 1.25, 3.8), (16384, 1.35, 4.5), (65536, 1.4, 5.0), (None, 1.4, 6.0))
#: Lengths, two to the octave, at which limits change.
EDGES = [math.ceil(2 ** (k / 2)) for k in range(16, 34)]
#: Limits of a corpus like the given one, from the 3,243 clean texts of sf0.1 (limits_of gives them). Lengths of which
#: the sample has too few keep the wide bands. They hold for prose like the sample's, in Latin script.
LIMITS = (
    (256, 0.5, 2.8), (363, 1.34, 1.7), (512, 1.37, 1.88), (725, 1.43, 1.91), (1024, 1.55, 2.01), (1449, 1.68, 2.08), (2048, 1.8, 2.19),
    (2897, 1.88, 2.2), (4096, 1.96, 2.26), (5793, 2.08, 2.33), (8192, 2.1, 2.38), (11586, 2.18, 2.42), (16384, 2.22, 2.45),
    (23171, 1.4, 5.0), (32768, 1.4, 5.0), (46341, 1.4, 5.0), (65536, 1.4, 5.0), (92682, 1.4, 6.0), (None, 1.4, 6.0),
)
#: Fixed chunks of a text, their band, and the share of chunks outside it that rejects the text.
#: Clean texts of sf0.1 have chunk ratios of 1.66 to 2.01, base64 text about 1.3.
CHUNK_BYTES, CHUNK_BAND, CHUNK_SHARE = 1024, (1.6, 2.6), 0.3
LEVEL = 3


def base_counts(text: str, raw: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text and its UTF-8."""
    words = raw.split()  # bytes split at 0x20, 0x09-0x0D alone
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, "#*$%&|<>"))
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
    n, repeat = len(words), 0
    if n > 3:
        seen: defaultdict = defaultdict()
        seen.default_factory = seen.__len__
        a = np.fromiter(map(seen.__getitem__, words), np.int64, n)
        pair = a[:-1] * len(seen) + a[1:]
        if len(seen) > 2_000_000:  # else the third word would not fit
            pair = np.unique(pair, return_inverse=True)[1]
        _, at, times = np.unique(pair[:-1] * len(seen) + a[2:], return_inverse=True, return_counts=True)
        twice, covered = times[at] > 1, np.zeros(n, bool)
        for shift in range(3):
            covered[shift : n - 2 + shift] |= twice
        repeat = int(covered.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeat


def chunks(raw: bytes) -> list[bytes]:
    """Chunks of CHUNK_BYTES bytes that hold every byte; the last one ends at the text's end."""
    starts = [*range(0, len(raw) - CHUNK_BYTES + 1, CHUNK_BYTES)]
    if len(raw) % CHUNK_BYTES:
        starts.append(len(raw) - CHUNK_BYTES)
    return [raw[i : i + CHUNK_BYTES] for i in starts]


def measured(batches: Iterator[pa.RecordBatch], bands=LIMITS) -> Iterator[pa.RecordBatch]:
    import zstandard

    pack = zstandard.ZstdCompressor(level=LEVEL).compress
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for batch in batches:
        out: dict[str, list] = {k: [] for k in (*names, "base_failed", "ratio", "bad_share", "kept")}
        for cell in batch.column(1):
            text = cell.as_py() or ""
            raw = text.encode()
            counts = base_counts(text, raw)
            failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
            ratio, bad = len(raw) / len(pack(raw)), 0.0
            _, least, most = next(x for x in bands if x[0] is None or len(raw) < x[0])
            if len(raw) >= CHUNK_BYTES:
                parts = chunks(raw)
                bad = sum(not CHUNK_BAND[0] <= len(x) / len(pack(x)) <= CHUNK_BAND[1] for x in parts) / len(parts)
            for k, v in zip(names, counts, strict=True):
                out[k].append(v)
            out["base_failed"].append(failed)
            out["ratio"].append(ratio)
            out["bad_share"].append(bad)
            out["kept"].append(not failed and least <= ratio <= most and bad <= CHUNK_SHARE)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v) for v in out.values())], [batch.schema.names[0], *out])


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands=LIMITS) -> DataFrame:
    """One row per row of ``docs``: id, counts, base_failed, ratio, bad_share, kept. No shuffle.

    ratio is raw size over zstd size of the whole text, held against the band for its length in ``bands``;
    bad_share is the share of 1024-byte chunks outside the chunk band, the last chunk ending at the
    text's end; a text shorter than a chunk is measured as a whole alone. Too high means repetitive, too low incompressible. Null text counts as empty:
    no words, so base_failed. Repeated rows each get the same verdict; an empty table none.
    """
    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, docs[text_col].cast("string").alias("vl_text")).mapInArrow(
        partial(measured, bands=bands),
        f"`{id_col}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, ratio double, bad_share double, kept boolean",
    )


def limits_of(docs: DataFrame, labels: DataFrame, least_texts: int = 20, margin: float = 0.04) -> list[tuple[int | None, float, float]]:
    """Bands for a corpus: least and most ratio of its clean texts by length, in one aggregation.

    docs(doc_id, text), labels(doc_id, quality). Clean are texts labelled 1 that pass the base
    rule; the sample's bound is the number of labels. Limits are widened by ``margin`` and rounded to
    0.01; lengths of fewer than ``least_texts`` clean texts keep the wide BANDS.
    """
    size = F.octet_length("text")
    below = F.coalesce(*[F.when(size < e, F.lit(e)) for e in EDGES])
    sized = docs.select("doc_id", below.alias("below")).join(labels.where("quality = 1"), "doc_id", "left_semi")
    clean = quality(docs.select("doc_id", "text"), bands=BANDS).where("not base_failed").join(sized, "doc_id").where("below is not null")
    rows = clean.groupBy("below").agg(F.min("ratio").alias("least"), F.max("ratio").alias("most"), F.count("*").alias("n")).collect()
    known = {r["below"]: (round(r["least"] - margin, 2), round(r["most"] + margin, 2)) for r in rows if r["n"] >= least_texts}
    wide = lambda e: next(x[1:] for x in BANDS if x[0] is None or e <= x[0])
    return [(e, *known.get(e, wide(e))) for e in EDGES] + [(None, *BANDS[-1][1:])]


def kept_rows(batches: Iterator[pa.RecordBatch], bands) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.names.index("vl_text")
        verdict = next(iter(measured(iter([pa.RecordBatch.from_arrays([batch.column(0), batch.column(at)], ["_id", "vl_text"])]), bands)))
        names = batch.schema.names[:at]
        yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(at)], names).filter(verdict.column("kept"))


def keep_good(docs: DataFrame, text_col: str = "text", bands=LIMITS) -> DataFrame:
    """The rows of ``docs`` that quality() keeps, with all their columns, in one pass and no join."""
    return docs.withColumn("vl_text", docs[text_col].cast("string")).mapInArrow(partial(kept_rows, bands=bands), docs.schema)
