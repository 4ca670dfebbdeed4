"""License scans: sparse TF-IDF cosine of headers and licence files to templates, then the
nearest ancestor directory's licence.  DataFrame operations only.

A file is a path and a text.  Its *header* segments are the lines that name a licence or a
copyright; a licence file (by its name) is also one segment as a whole.  Segments become
token counts; weights are count * idf, where idf counts the templates that have the token
(a token of no template has the idf of a document count of zero), so the join side of
every token is the bounded template table.  Four comparisons are made:

* lines and licence files with the notices (``TEMPLATES``), by words;
* lines, pairs of lines and sentences around a header line with notices and further short
  forms (``FORMS``), by words, each form a vector of its own;
* licence files with whole licence texts (``license_texts``), by runs of three words;
* each identifier of an ``SPDX-License-Identifier`` line with the known ones.

A file takes the template of its best segment if the cosine reaches ``threshold`` (ties: the
smaller licence id).  Of ``CC-BY-4.0`` and the other CC licences but CC-BY-SA-4.0 there is no
whole text; they are found by name.

A file without an own licence takes that of the nearest directory, its own one or an
ancestor, which holds a licence file with a licence (ties: the smallest path).  Inheritance
is solved on the distinct directories, not on files, so a directory with a third of all
files costs one row there; texts are never shuffled.

Cases: rows with a null path have no licence; a null text has no header; rows with equal
paths are one file with several texts and all get its result; empty tables give no rows.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import clash_proof, stored

THRESHOLD = 0.6
HEADER = r"(?i)licen[sc]|copyright|spdx"
LICENSE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice|unlicense)([.\-_][^/]*)?$"
TOKEN = r"[a-z0-9]+(?:\.[0-9]+)*"

# fixed values: short notices by which files name their licence
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be "
                     "found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0."),
    ("Proprietary", "Copyright. All rights reserved."),
)


# further short forms, one vector each: names, headings and usual headers
_GNU = ("This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU {}General Public License as published by the Free Software Foundation; ")
_GNU_NAMES = (("GPL-1.0", "", "1"), ("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.0", "Library ", "2"),
              ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3"))
_CC_NAMES = (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
             ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
             ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
FORMS = (
    ("Apache-2.0", "Apache License Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
                   "file except in compliance with the License."),
    ("Apache-1.1", "Apache Software License, Version 1.1"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", 'BSD 3-Clause "New" or "Revised" License'),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-2-Clause", 'BSD 2-Clause "Simplified" License'),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "ISC License"),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            'and associated documentation files (the "Software"), to deal in the Software without '
            "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
            "Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-1.1", "Mozilla Public License Version 1.1"),
    *((k, f"GNU {name}General Public License version {v}") for k, name, v in _GNU_NAMES),
    *((k, _GNU.format(name) + f"either version {v} of the License, or (at your option) any later version.")
      for k, name, v in _GNU_NAMES),
    *((k, _GNU.format(name) + f"version {v} of the License.") for k, name, v in _GNU_NAMES),
    *((f"CC-{k}-{v}", text) for k, name in _CC_NAMES for v in ("3.0", "4.0") for text in (
        f"Creative Commons {name} {v} International Public License",
        f"This work is licensed under a Creative Commons {name} {v} International License.",
        f"License: CC {k} {v}")),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal License"),
)
# SPDX identifiers that are not the licence id itself
_GNU_IDS = ("AGPL-3.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0")
SPDX = tuple((k, k + more) for k in _GNU_IDS for more in ("-only", "-or-later", "+"))
SPDX_LINE = r"(?i)SPDX-License-Identifier:[ \t(]*([^\r\n]*)"
# comment leaders and rules at the start of a line
LEADER = r"^[ \t]*(?:[#*/;%!|<>-]+|//+|REM\b|dnl\b)*[ \t]*"
SENTENCE = r"(?<=[.!?;:])\s+(?=[A-Z\"'(])"
NOTICE, FORM, TEXT, NAME = "notice", "form", "text", "spdx"
GRAM = 3  # words of a token of a whole text


def texts() -> list[tuple[str, str]]:
    """(license_id, whole text) of the files of ``license_texts``."""
    folder = resources.files("tillroll.llm").joinpath("license_texts")
    return sorted((f.name[:-4], f.read_text("utf-8")) for f in folder.iterdir() if f.name.endswith(".txt"))


def templates(spark: SparkSession) -> DataFrame:
    """(license_id, template, kind) of notices, short forms, whole texts and SPDX identifiers."""
    whole = texts()
    ids = sorted({k for k, _ in (*TEMPLATES, *FORMS, *whole)} - {"Proprietary"})
    rows = [
        *((*x, NOTICE) for x in TEMPLATES), *((*x, FORM) for x in FORMS), *((*x, TEXT) for x in whole),
        *((k, k, NAME) for k in ids), *((*x, NAME) for x in SPDX),
    ]
    return spark.createDataFrame(rows, "license_id string, template string, kind string")


def _words(text: str):
    return F.regexp_extract_all(F.lower(F.col(text)), F.lit(TOKEN), F.lit(0))


def _grams(text: str):
    """Runs of GRAM words; the words are bound once, not per run."""
    runs = F.transform(F.array(_words(text)), lambda w: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - GRAM, F.lit(0))),
        lambda i: F.array_join(F.slice(w, i + 1, GRAM), " "),
    ))
    return F.element_at(runs, 1)


def _counts(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Token counts; what a token is depends on the comparison (column ``kind``)."""
    kind = F.col("kind")
    tokens = F.when(kind == TEXT, _grams(text)).when(kind == NAME, F.array(F.lower(F.col(text))))
    return (
        df.select(*keys, "kind", F.explode(tokens.otherwise(_words(text))).alias("token"))
        .groupBy(*keys, "kind", "token").agg(F.count("*").alias("tf"))
    )


def _template_weights(known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kind, token, idf, licences: array of (vector, license_id, weight / norm)) and per kind
    the idf of tokens that no template has.  Templates of one ``vector`` are one."""
    tf = _counts(known, ["vector", "license_id"], "template")
    n = known.groupBy("kind").agg(F.countDistinct("vector").alias("n"))
    idf = F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1
    df = tf.groupBy("kind", "token").agg(F.count("*").alias("df")).join(F.broadcast(n), "kind")
    weighed = tf.join(df.select("kind", "token", idf.alias("idf")), ["kind", "token"]).withColumn(
        "w", F.col("tf") * F.col("idf")
    )
    norms = weighed.groupBy("kind", "vector").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    rows = weighed.join(norms, ["kind", "vector"])
    table = rows.groupBy("kind", "token", "idf").agg(F.collect_list(
        F.struct("vector", "license_id", (F.col("w") / F.col("norm")).alias("w"))
    ).alias("licences"))
    return table, n.select("kind", (F.log(F.col("n") + 1) + 1).alias("unknown"))


def _windows(lines):
    """Around each header line: it with the next one, and the sentences of the lines from
    two before it to three after it that name a licence; comment leaders removed."""
    bare = F.transform(lines, lambda x: F.regexp_replace(x, LEADER, ""))
    # the lines are bound once, not per header line
    found = F.transform(F.array(bare), lambda a: F.flatten(F.transform(
        F.filter(F.sequence(F.lit(1), F.size(a)), lambda i: F.element_at(a, i).rlike(HEADER)),
        lambda i: F.concat(
            F.array(F.element_at(a, i), F.array_join(F.slice(a, i, 2), " ")),
            F.split(F.array_join(F.slice(a, F.greatest(i - 2, F.lit(1)), F.least(i + 3, F.lit(6))), " "), SENTENCE),
        ),
    )))
    return F.filter(F.element_at(found, 1), lambda x: x.rlike(HEADER))


def own_licenses(
    files: DataFrame, known: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """(path, license_id, score) of files with a header or licence text near a template.

    ``known`` (license_id, template and, if not all are notices, kind) is a bounded table of
    templates; it is broadcast.
    """
    if "kind" not in known.columns:
        known = known.withColumn("kind", F.lit(NOTICE))
    # notices take part twice: all of a licence as one vector, and each among the short forms
    one = F.when(F.col("kind") == NOTICE, F.col("license_id")).otherwise(
        F.concat_ws("#", "license_id", F.xxhash64("template"))
    )
    twice = known.where(F.col("kind") == NOTICE).withColumn("kind", F.lit(FORM))
    known = known.unionByName(twice).withColumn("vector", one)
    lines = F.split("text", "\n")
    headers = F.filter(lines, lambda x: x.rlike(HEADER))
    whole = F.when(F.col("path").rlike(LICENSE_FILE), F.array("text")).otherwise(F.array())
    # every identifier of an SPDX expression is a segment
    expressions = F.regexp_extract_all("text", F.lit(SPDX_LINE), F.lit(1))
    names = F.flatten(F.transform(
        expressions, lambda x: F.regexp_extract_all(x, F.lit(r"[A-Za-z0-9][A-Za-z0-9.+-]*"), F.lit(0))
    ))

    def of(kind, found):
        return F.transform(
            F.array_distinct(found), lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("segment"))
        )

    compared = F.concat(
        of(NOTICE, F.concat(headers, whole)), of(FORM, _windows(lines)), of(TEXT, whole), of(NAME, names)
    )
    segments = (
        files.where(F.col("path").isNotNull() & F.col("text").rlike(HEADER))
        .select("path", F.explode(compared).alias("s")).select("path", "s.kind", "s.segment")
        .distinct()  # a segment that many rows of one path repeat counts once
        .withColumn("segment_id", F.xxhash64("segment"))
    )
    weights, unknown = _template_weights(known)
    weights = stored(weights, "templates")  # read twice
    tf = _counts(segments, ["path", "segment_id"], "segment")
    weighed = (
        tf.join(F.broadcast(weights), ["kind", "token"], "left").join(F.broadcast(unknown), "kind")
        .withColumn("w", F.col("tf") * F.coalesce("idf", "unknown"))
    )
    key = ["path", "kind", "segment_id"]
    # one shuffle for both: the norm, and the products with every template
    norms = weighed.groupBy(*key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = (
        weighed.select(*key, "w", F.explode("licences").alias("l"))
        .groupBy(*key, F.col("l.vector").alias("vector"), F.col("l.license_id").alias("license_id"))
        .agg(F.sum(F.col("w") * F.col("l.w")).alias("dot"))
    )
    scored = dots.join(norms, key).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
    best = F.min(F.struct((-F.col("score")).alias("s"), "license_id"))
    return (
        scored.where(F.col("score") >= threshold).groupBy("path").agg(best.alias("b"))
        .select("path", F.col("b.license_id").alias("license_id"), (-F.col("b.s")).alias("score"))
    )


def _directory(path):
    """The directory of a path ('' for the top)."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def directory_licenses(files: DataFrame, own: DataFrame) -> DataFrame:
    """(directory, license_id, license_path) for each directory of ``files`` that has a
    licence file in itself or in an ancestor, the nearest one."""
    licence_files = own.where(F.col("path").rlike(LICENSE_FILE))
    holders = (
        licence_files.groupBy(_directory(F.col("path")).alias("holder"))
        .agg(F.min(F.struct("path", "license_id")).alias("l"))
    )
    parts = F.split("directory", "/")
    up_to = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/")
    )
    directories = (
        files.where(F.col("path").isNotNull())
        .select(_directory(F.col("path")).alias("directory")).distinct()
    )
    ancestors = directories.select(
        "directory", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), up_to))).alias("ancestor")
    )
    nearest = F.max(F.struct(F.length("ancestor").alias("depth"), "l"))
    return (
        ancestors.join(holders, F.col("ancestor") == F.col("holder"))
        .groupBy("directory").agg(nearest.alias("n"))
        .select("directory", F.col("n.l.license_id").alias("license_id"), F.col("n.l.path").alias("license_path"))
    )


@clash_proof(reads=("path", "text"))
def scan(files: DataFrame, known: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` (path, text, more columns) without the text plus license_id, score, origin
    ('own', 'inherited' or null) and license_path (the file the licence was read from)."""
    added = ("license_id", "score", "origin", "license_path")
    keep = [f"`{c}`" for c in files.columns if c not in ("text", *added)]
    own = stored(own_licenses(files, known, threshold), "licences")  # read twice
    above = directory_licenses(files, own)
    mine = own.select(
        F.col("path").alias("_path"), F.col("license_id").alias("_own"), F.col("score").alias("_score")
    )
    near = above.select(
        F.col("directory").alias("_dir"), F.col("license_id").alias("_above"),
        F.col("license_path").alias("_from"),
    )
    has = F.col("_own").isNotNull()
    return (
        files.select(*keep).join(mine, F.col("path") == F.col("_path"), "left")
        .join(near, _directory(F.col("path")) == F.col("_dir"), "left")
        .select(
            *keep, F.coalesce("_own", "_above").alias("license_id"),
            F.col("_score").alias("score"),
            F.when(has, "own").when(F.col("_above").isNotNull(), "inherited").alias("origin"),
            F.when(has, F.col("path")).otherwise(F.col("_from")).alias("license_path"),
        )
    )
