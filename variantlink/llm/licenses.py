"""License scans by a positional rare-token index (operator 3)."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, staged, text_of

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases whose places are counted, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Words of public licences that several of them share.
AS_IS = (
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability "
    "fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other "
    "liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"
)
BSD_CONDITIONS = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
    "1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation "
    "and or other materials provided with the distribution"
)
BSD_DISCLAIMER = (
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied "
    "warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any "
    "direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use "
    "data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or "
    "otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
)
GNU_NOTICE = (
    "this program is free software you can redistribute it and or modify it under the terms of the gnu {name} public license as published by the free software "
    "foundation either version {version} of the license or at your option any later version this program is distributed in the hope that it will be useful but "
    "without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu {name} public license for more details"
)
#: Fixed values: (label, mandatory key phrase, wording), in the words of the public licences: sentences, notices and whole licences.
TEMPLATES = (
    ("apache-2.0", "apache license version 2 0", "licensed under the apache license version 2 0"),
    (
        "apache-2.0", "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is "
        "basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    ),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-2-clause", "provided with the distribution this software", f"{BSD_CONDITIONS} {BSD_DISCLAIMER}"),
    (
        "bsd-3-clause", "contributors may be used to endorse or promote products",
        f"{BSD_CONDITIONS} 3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        f"without specific prior written permission {BSD_DISCLAIMER}",
    ),
    (
        "bsl-1.0", "obtaining a copy of the software and accompanying documentation",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software "
        "to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so",
    ),
    ("cc-by-4.0", "cc by 4 0", "licensed under cc by 4 0"),
    ("cc-by-4.0", "creative commons attribution 4 0", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", "cc by nc 4 0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "cc by sa 4 0", "licensed under cc by sa 4 0"),
    ("cc0-1.0", "cc0 1 0", "dedicated to the public domain under cc0 1 0 universal"),
    ("gpl-2.0", "gnu general public license version 2", "licensed under the gnu general public license version 2"),
    ("gpl-3.0", "gnu general public license version 3", "licensed under the gnu general public license version 3"),
    ("isc", "with or without fee is hereby granted", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    (
        "isc", "with or without fee is hereby granted",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission "
        "notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability "
        "and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits",
    ),
    ("mit", "released under the mit license", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    (
        "mit", "permission is hereby granted free of charge",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without "
        "restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the "
        f"software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software {AS_IS}",
    ),
    ("unlicense", "free and unencumbered software", "this is free and unencumbered software released into the public domain"),
    (
        "unlicense", "free and unencumbered software",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form "
        "or as a compiled binary for any purpose commercial or non commercial and by any means",
    ),
    ("zlib", "without any express or implied warranty", "this software is provided as is without any express or implied warranty"),
    (
        "zlib", "misrepresented you must not claim",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is "
        "granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions 1 the origin "
        "of this software must not be misrepresented you must not claim that you wrote the original software",
    ),
)
#: Licences that are named with a version: label, name and versions, and the words between the two.
NAMED = (
    ("agpl", "gnu affero general public license", ("1 0", "3")),
    ("artistic", "artistic license", ("1 0", "2 0")),
    ("bsl", "boost software license", ("1 0",)),
    ("epl", "eclipse public license", ("1 0", "2 0")),
    ("gpl", "gnu general public license", ("2", "3")),
    ("lgpl", "gnu lesser general public license", ("2 1", "3")),
    ("mpl", "mozilla public license", ("1 1", "2 0")),
)
BETWEEN = ("", "version ", "v ")
#: Notices of the licences that have one, as versions stand in them, and short names that tell a licence by themselves.
NOTICES = (("agpl-3.0", "affero general", "3"), ("gpl-2.0", "general", "2"), ("gpl-3.0", "general", "3"), ("lgpl-2.1", "lesser general", "2 1"), ("lgpl-3.0", "lesser general", "3"))
SHORT = {"gpl-2.0": ("gplv2", "gpl v2"), "gpl-3.0": ("gplv3", "gpl v3"), "lgpl-3.0": ("lgplv3", "lgpl v3"), "agpl-3.0": ("agplv3", "agpl v3")}
#: Identifiers in SPDX expressions, in lower case, and their suffixes that leave the licence as it is.
SPDX = (
    "agpl-1.0 agpl-3.0 apache-2.0 artistic-1.0 artistic-2.0 bsd-2-clause bsd-3-clause bsd-3-clause-clear bsl-1.0 cc-by-4.0 cc-by-nc-4.0 cc-by-sa-4.0 cc0-1.0 "
    "epl-1.0 epl-2.0 gpl-2.0 gpl-3.0 isc lgpl-2.1 lgpl-3.0 mit mpl-1.1 mpl-2.0 unlicense zlib"
).split()
SPDX_SUFFIX = r"(?:-or-later|-only|\+)?\.?$"
OPERAND = r"(?:\([ \t]*)*[a-z0-9][a-z0-9.+-]*(?:[ \t]*\))*"
EXPRESSION = rf"spdx-license-identifier:[ \t]*({OPERAND}(?:[ \t]+(?:and|or|with)[ \t]+{OPERAND})*)"


def _versions() -> list[tuple[str, str, str]]:
    """Every name with every version: the key phrase holds the version, so another version never passes.

    A whole version needs a word before it, as a bare number may be anything.
    """
    out = []
    for short, name, versions in NAMED:
        for version in versions:
            label = f"{short}-{version.replace(' ', '.')}" + ".0" * (" " not in version)
            phrases = [f"{name} {between}{version}" for between in BETWEEN if between or " " in version]
            out += [(label, phrase, phrase) for phrase in phrases]
    return out


TEMPLATES += tuple(_versions())
TEMPLATES += tuple(
    (label, f"gnu {name} public license as published by the free software foundation either version {version}", GNU_NOTICE.format(name=name, version=version))
    for label, name, version in NOTICES
)
TEMPLATES += tuple((label, x, x) for label, names in SHORT.items() for x in names)
#: Function words are no licence words: they have next to no weight, and stand in every text.
FUNCTION_WORDS = frozenset("a an and any are as at available be by for if in into is it its met of on or such that the this to way will with you".split())

#: Share of a template's words that must align, and the words that may stand between them in the file: half a window.
ALIGNED, WINDOW = 0.7, 8


def tokens_of(text: str) -> list[tuple[str, int]]:
    """Licence words of a template and their places among all its words."""
    return [(w, k) for k, w in enumerate(text.split()) if w not in FUNCTION_WORDS]


def key_places(key: str, text: str) -> list[int]:
    """Places of the key phrase's licence words in the template."""
    words, own = text.split(), key.split()
    at = next(k for k in range(len(words)) if words[k : k + len(own)] == own)
    return [at + k for k, w in enumerate(own) if w not in FUNCTION_WORDS]


def spdx_labels(text: Column) -> Column:
    """Labels of all known licences in the SPDX expressions of a text in lower case, whatever joins them; null without any."""
    tagged = F.contains(text, F.lit("spdx-license-identifier"))
    operands = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(EXPRESSION), F.lit(1)), lambda x: F.split(x, r"[ \t()]+")))
    known = F.filter(F.transform(operands, lambda x: F.regexp_replace(x, SPDX_SUFFIX, "")), lambda x: x.isin(SPDX))
    return F.when(tagged, F.array_distinct(known))


def phrase_starts(hits: Column, phrase: str) -> Column:
    """Where a phrase's words, licence words all, stand consecutively."""

    def at(h: Column, i: Column) -> Column:
        test = h["word"] == phrase.split()[0]
        for k, word in enumerate(phrase.split()[1:], 1):
            follower = F.get(hits, i + k)
            test = test & F.coalesce((follower["word"] == word) & (follower["pos"] == h["pos"] + k), F.lit(False))
        return F.when(test, h["pos"])

    return F.array_compact(F.transform(hits, at))


def small_table(spark: SparkSession, rows: list[tuple], fields: str) -> DataFrame:
    """Rows of the driver as a table to broadcast, by way of one literal; here never more than the templates have words."""
    names = [x.split(":")[0] for x in fields.split(",")]
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    return F.broadcast(spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{fields}>>"))))


def proposed(files: DataFrame, templates, idf: dict[str, float]) -> DataFrame:
    """``(r, label, share)``: templates that stand in a file, from ``files(r, hits)`` with arrays of (word, pos).

    The index maps a word to its places in the templates. Of each template the words of highest IDF are
    looked up, one more than may be out of line, so that an aligned template always has one among
    them. The postings of templates proposed so are intersected by relative position: words whose position in
    the file less that in the template falls in one window of WINDOW words (two series of windows, half a window
    apart) count together. A template stands where ALIGNED of its words do, and its key phrase's words
    stand at one relative position, exactly, in that window.
    """
    rows, lookups = [], set()
    for t, (label, key, text) in enumerate(templates):
        own, keys = tokens_of(text), key_places(key, text)
        rows += [(w, t, k, k in keys, len(keys), len(own), label) for w, k in own]
        rarest = sorted(own, key=lambda x: (-idf[x[0]], x))[: len(own) - math.ceil(ALIGNED * len(own)) + 1]
        lookups |= {(w, t) for w, _ in rarest}
    spark = files.sparkSession
    index = small_table(spark, rows, "word:string,t:int,k:int,in_key:boolean,n_key:int,size:int,label:string")
    named = files.select("r", F.inline("hits")).join(small_table(spark, sorted(lookups), "word:string,t:int"), "word")
    named = named.groupBy("r").agg(F.collect_set("t").alias("ts"))
    start = (F.col("pos") - F.col("k")).alias("start")
    # postings are multiplied by the index in files with a proposal alone
    postings = files.join(named, "r").select("r", "ts", F.inline("hits")).join(index, "word").where(F.array_contains("ts", F.col("t")))
    aligned = postings.select("r", "t", start, "k", "in_key", "n_key", "size", "label")
    exact = aligned.groupBy("r", "t", "start", "n_key", "size", "label").agg(F.collect_list("k").alias("ks"), F.count_if("in_key").alias("keys"))
    half = [F.struct(F.lit(s).alias("series"), F.floor((F.col("start") + s * WINDOW // 2) / WINDOW).alias("w")) for s in (0, 1)]
    windows = exact.select("*", F.inline(F.array(*half))).groupBy("r", "t", "series", "w", "size", "label")
    found = windows.agg(F.size(F.array_distinct(F.flatten(F.collect_list("ks")))).alias("n"), F.max(F.col("keys") == F.col("n_key")).alias("key"))
    return found.where(F.col("key") & (F.col("n") >= ALIGNED * F.col("size"))).select("r", "label", (F.col("n") / F.col("size")).alias("share"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    A first pass over the texts writes each file's licence words with their positions. Document
    frequencies of these words (a fixed list, so the driver may hold them) give their IDF over the whole corpus.
    Templates are then found by the positional index (see proposed), licence words alone moving;
    a file may hold any number of licences.

    SPDX expressions are read as such: all their known licences are labels. score is the best share of aligned words of
    an accepted template, 1 where a base phrase or an SPDX expression stands, else 0. Null and empty texts give no words, empty labels, score 0.
    Repeated rows give repeated results; other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    vocabulary = sorted({w for phrase in BASE for w in phrase.split()} | {w for _, _, text in templates for w, _ in tokens_of(text)})
    listed = F.split(F.lit(" ".join(vocabulary)), " ")
    lowered = ascii_lower(text_of(text_col))
    words = F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))
    hits = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("pos"))), lambda h: h["word"].isin(vocabulary))
    hits = F.when(F.arrays_overlap("words", listed), hits).otherwise(F.array().cast("array<struct<word:string,pos:int>>"))
    files = docs.select(F.col(id_col).alias("id"), words.alias("words"), spdx_labels(lowered).alias("spdx")).select(
        "id", "spdx", F.monotonically_increasing_id().alias("r"), F.size("words").cast("long").alias("n_words"), hits.alias("hits")
    )
    files = staged(files, "license-words")
    total = files.count()
    df = {r["word"]: r["n"] for r in files.select(F.explode(F.array_distinct("hits.word")).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    idf = {w: math.log((total + 1) / (df.get(w, 0) + 0.5)) for w in vocabulary}
    found = proposed(files.where(F.size("hits") > 0).select("r", "hits"), templates, idf)
    told = staged(found.groupBy("r").agg(F.collect_set("label").alias("named"), F.max("share").alias("share")), "licenses")
    base = F.array(*[F.struct(F.lit(label).alias("label"), phrase_starts(F.col("hits"), phrase).alias("at")) for phrase, label in BASE.items()])
    step = files.join(told, "r", "left").withColumn("base", base)
    starts = F.flatten(F.col("base.at"))
    labels = F.transform(F.filter("base", lambda b: F.size(b["at"]) > 0), lambda b: b["label"])
    none = F.array().cast("array<string>")
    every = F.array_union(F.array_union(labels, F.coalesce("named", none)), F.coalesce("spdx", none))
    sure = (F.size(starts) > 0) | F.coalesce(F.size("spdx") > 0, F.lit(False))
    return step.select(
        F.col("id").alias(id_col),
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(every)), ",").alias("labels"),
        F.greatest(F.when(sure, 1.0).otherwise(0.0), F.coalesce("share", F.lit(0.0))).alias("score"),
    )
