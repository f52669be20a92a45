"""Fill-in-middle transformation by repeated-capture matching (operator 12)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: One match of this keeps every unit as a repetition of group 1; possessive, so that no way back is stored.
UNITS = r"([A-Za-z]++|[^A-Za-z])*+"
#: Code points of one match: the library stores a few dozen bytes for each repetition. Longer texts take several, joined without loss.
WINDOW = 1 << 18
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Shares in percent: documents that are transformed, and those of them with the suffix first.
RATE, SPM = 90, 20


def unit_ends(text: str, units, window: int = WINDOW) -> list[int]:
    """Ends of all units of a text, in code points. A run of letters that a window cuts is one unit."""
    ends = units.fullmatch(text, 0, window).ends(1)
    for at in range(window, len(text), window):
        if (text[at - 1] + text[at]).isascii() and text[at - 1].isalpha() and text[at].isalpha():
            ends.pop()
        ends += units.fullmatch(text, at, at + window).ends(1)
    return ends


def cuts_of(text: Column, h1: Column, h2: Column) -> Column:
    """Struct of n (units), first and last (both cut offsets in code points) for draws h1 and h2."""

    @F.arrow_udf("n long, first long, last long")
    def cut(texts: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        import regex

        units, out = regex.compile(UNITS), []
        for cell, x, y in zip(texts, a.to_pylist(), b.to_pylist(), strict=True):
            ends = unit_ends(cell.as_py(), units)
            n = len(ends)
            at = [0 if u == 0 else ends[u - 1] for u in sorted((x % (n + 1), y % (n + 1)))]
            out.append((n, *at))
        kind = pa.struct([("n", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])
        return pa.array([dict(zip(("n", "first", "last"), r, strict=True)) for r in out], kind)

    return cut(text, h1, h2)


def draws(id_col: str, seed: int) -> list[Column]:
    """Four unsigned draws from the hash of ``seed:id``; a null id is hashed as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """One row per row of ``docs``: id, text, n, form, prefix_chars, middle_chars, output.

    A text is cut into n units (a run of A-Z and a-z, or one other code point); prefix and middle end after the
    smaller and the larger of two drawn numbers of units. form is "psm" (prefix, suffix, middle), "spm" (suffix,
    prefix, middle) or "plain": empty texts, texts that contain a marker, and 100 - ``rate`` percent of the others.
    Only two offsets for each text come back from Python; the output is put together in the JVM.

    Null text counts as empty. Repeated rows give repeated results. Other columns are ignored, whatever their
    names; an empty table gives an empty result.
    """
    h1, h2, h3, h4 = (F.col("h").getItem(k) for k in range(4))
    own = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"), F.array(*draws(id_col, seed)).alias("h"))
    cut = own.withColumn("c", cuts_of(F.col("t"), h1, h2))
    marked = F.contains("t", F.lit(PREFIX)) | F.contains("t", F.lit(SUFFIX)) | F.contains("t", F.lit(MIDDLE))
    plain = (F.col("t") == "") | marked | (h3 % 100 >= rate)
    prefix = F.substring(F.col("t"), F.lit(1), F.col("c.first").cast("int"))
    middle = F.substring(F.col("t"), (F.col("c.first") + 1).cast("int"), (F.col("c.last") - F.col("c.first")).cast("int"))
    suffix = F.substring(F.col("t"), (F.col("c.last") + 1).cast("int"), F.lit(2147483647))
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm_text = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    formed = cut.withColumn("form", F.when(plain, "plain").when(h4 % 100 < spm, "spm").otherwise("psm"))
    cuts = F.col("form") != "plain"
    return formed.select(
        F.col("id").alias(id_col),
        F.col("t").alias("text"),
        F.col("c.n").alias("n"),
        "form",
        F.when(cuts, F.col("c.first")).alias("prefix_chars"),
        F.when(cuts, F.col("c.last") - F.col("c.first")).alias("middle_chars"),
        F.when(~cuts, F.col("t")).when(F.col("form") == "psm", psm).otherwise(spm_text).alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text from its output and form. No marker stands in a cut text, and none can arise at a seam: a
    marker's first character differs from all its others."""
    part = [F.get(F.split(output, "<[PSM]>", -1), F.lit(k)) for k in range(4)]
    return F.when(form == "plain", output).when(form == "psm", F.concat(part[1], part[3], part[2])).otherwise(F.concat(part[2], part[3], part[1]))
