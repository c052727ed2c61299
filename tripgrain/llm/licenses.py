"""Licences of files: TF-IDF cosine of statements to templates, and inheritance by directories.

A file's lines and paragraphs that mention a licence are compared with templates. Terms are
weighted by how few of all files have them; the vectors are sparse rows of (passage, term), and
dot products are sums over the terms a passage and a template share. A file states the licence
of the most similar template, if similar enough. A licence file, known by its name or by being
similar to a template as a whole, also speaks for its directory: a file without a statement of its
own inherits from the nearest directory above it that has one.

Defined results: NULL and empty texts state nothing; a NULL path is in no directory and inherits
nothing; of equal similarities the template first in name order counts, of several licence files in
a directory the one of the highest similarity, then the first licence name; rows with equal paths
are separate files; result columns replace input columns of the same name. Texts are read whole.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripgrain.durable import cut_lineage
from tripgrain.llm.columns import fresh_name, prepare_workers, whole_text, with_results

# For a statement, and for a text that is nothing but a licence.
MIN_COSINE, WHOLE_COSINE = 0.6, 0.8

# Statements by which licences are usually named, by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
     "this file except in compliance with the License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, "
     "are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files, to deal in the software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
MENTIONS = re.compile(
    r"licen[sc]|copyright|rights\s+reserved|public\s+domain|permission\s+is\s+hereby|"
    r"redistribution\s+and\s+use|\bcc[\s-]?(?:by|0)\b|\bspdx\b",
    re.IGNORECASE,
)
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|unlicense|notice)([._-].*)?$"
TERM_SEPARATOR = r"[^\p{L}\p{N}]+"

_COMMENT = re.compile(r"^[\s/*#;%!-]+|[\s*/-]+$")


def passages_of(text: str) -> list[str]:
    """The distinct lines and paragraphs that mention a licence, without comment signs."""
    if not MENTIONS.search(text):
        return []
    found: dict[str, None] = {}
    for paragraph in re.split(r"\n\s*\n", text):
        if MENTIONS.search(paragraph):
            lines = [_COMMENT.sub("", line) for line in paragraph.split("\n")]
            found.update(dict.fromkeys(line for line in lines if MENTIONS.search(line)))
            found[" ".join(lines)] = None
    found[" ".join(text.split())] = None  # the text as a whole, for licence files
    return list(found)


def _terms(text: Column) -> Column:
    words = F.split(F.lower(text), TERM_SEPARATOR)
    return F.filter(words, lambda word: word != "")


def _weights(rows: DataFrame, keys: list[str], idf: DataFrame) -> DataFrame:
    """`keys, term, weight` with unit length for each text in column `content`."""
    counted = (
        rows.select(*keys, F.explode(_terms(F.col("content"))).alias("term"))
        .groupBy(*keys, "term")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    weighed = counted.join(idf, "term", "left").select(
        *keys,
        "term",
        ((1 + F.log("times")) * F.coalesce("idf", F.lit(1.0))).alias("raw"),
    )
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(*keys)))
    return weighed.select(*keys, "term", (F.col("raw") / length).alias("weight"))


def inverse_frequencies(texts: DataFrame) -> DataFrame:
    """`term, idf` over all rows of a table with a column `content`."""
    files = texts.count()
    frequencies = (
        texts.select(F.explode(F.array_distinct(_terms(F.col("content")))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )
    return frequencies.select("term", F.log((1 + files) / (1 + F.col("df")) + 1).alias("idf"))


def _templates(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    rows = [(at, name, content) for at, (name, content) in enumerate(templates)]
    return spark.createDataFrame(rows, "template int, license string, content string")


def stated_licenses(
    texts: DataFrame, min_cosine: float, templates: list[tuple[str, str]]
) -> DataFrame:
    """`key, license, similarity, whole` of texts (`key`, `content`) that state a licence.

    `whole` is true where the text as a whole is the statement.
    """

    def find_batch(contents: pa.Array) -> pa.Array:
        found = [passages_of(content.as_py()) for content in contents]
        return pa.array(found, type=pa.list_(pa.string()))

    found = F.arrow_udf(find_batch, "array<string>")(F.col("content"))
    mentions = cut_lineage(
        texts.select("key", found.alias("passages"))
        .filter(F.size("passages") > 0)
        .dropDuplicates(["key"])
        .select("key", F.size("passages").alias("n"), F.posexplode("passages"))
        .select("key", "pos", (F.col("pos") == F.col("n") - 1).alias("whole"), F.col("col").alias("content"))
    )
    shown = _templates(texts.sparkSession, templates)
    vocabulary = (
        mentions.select("content").unionByName(shown.select("content"))
        .select(F.explode(_terms(F.col("content"))).alias("term")).distinct()
    )
    idf = cut_lineage(inverse_frequencies(texts).join(vocabulary, "term", "left_semi"))
    passages = _weights(mentions, ["key", "pos", "whole"], idf)
    patterns = _weights(shown, ["template", "license"], idf).withColumnRenamed("weight", "pattern")
    # The templates are a parameter of a few hundred terms.
    cosines = (
        passages.join(F.broadcast(patterns), "term")
        .groupBy("key", "pos", "whole", "template", "license")
        .agg(F.round(F.sum(F.col("weight") * F.col("pattern")), 9).alias("similarity"))
        .filter(F.col("similarity") >= min_cosine)
        .withColumn("whole", F.col("whole") & (F.col("similarity") >= WHOLE_COSINE))
    )
    best = F.max(F.struct("similarity", F.negate("rank").alias("rank"), "license")).alias("best")
    names = sorted({name for name, _ in templates})
    rank = F.array_position(F.array(*[F.lit(name) for name in names]), F.col("license"))
    ranked = cosines.withColumn("rank", rank)
    return ranked.groupBy("key").agg(best, F.bool_or("whole").alias("whole")).select(
        "key", "best.license", "best.similarity", "whole"
    )


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def inherited_licenses(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """`directory, license, from_directory` from the nearest licensed directory at or above.

    Works on distinct directories, so a directory of any number of files is one row. A path of n
    parts has n + 1 directories above it.
    """
    parts = F.split("directory", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda depth: F.struct(
            depth.alias("depth"), F.array_join(F.slice(parts, 1, depth), "/").alias("at")
        ),
    )
    ancestors = directories.select("directory", F.explode(F.array_distinct(above)).alias("a"))
    ancestors = ancestors.select("directory", "a.depth", F.col("a.at").alias("at"))
    found = ancestors.join(licensed.withColumnRenamed("directory", "at"), "at")
    nearest = F.max(F.struct("depth", "license", "at")).alias("nearest")
    return found.groupBy("directory").agg(nearest).select(
        "directory", "nearest.license", F.col("nearest.at").alias("from_directory")
    )


def scan_licenses(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    min_cosine: float = MIN_COSINE,
    templates: list[tuple[str, str]] = TEMPLATES,
) -> DataFrame:
    """Files with `license`, `similarity`, `origin` and `from_directory`.

    `origin` is stated, inherited or none.
    """
    prepare_workers(files.sparkSession)
    key, folder = fresh_name(files, "text_key"), fresh_name(files, "folder")
    content = whole_text(text)
    texts = files.select(F.md5(content.cast("binary")).alias("key"), content.alias("content"))
    stated = cut_lineage(stated_licenses(texts, min_cosine, templates))
    located = files.select(
        F.col(f"`{path}`").cast("string").alias("path"),
        F.md5(content.cast("binary")).alias("key"),
    ).filter("path is not null")
    is_licence = F.regexp_like(F.regexp_extract("path", r"[^/]*$", 0), F.lit(LICENCE_FILE))
    speaking = located.join(stated, "key").filter(is_licence | F.col("whole"))
    order = F.max(F.struct("similarity", F.negate("rank").alias("rank"), "license")).alias("best")
    names = sorted({name for name, _ in templates})
    rank = F.array_position(F.array(*[F.lit(name) for name in names]), F.col("license"))
    licensed = (
        speaking.withColumn("directory", _directory(F.col("path")))
        .withColumn("rank", rank)
        .groupBy("directory").agg(order).select("directory", "best.license")
    )
    directories = located.select(_directory(F.col("path")).alias("directory")).distinct()
    inherited = inherited_licenses(directories, cut_lineage(licensed))
    own = stated.select(
        F.col("key").alias(key), F.col("license").alias(f"{key}_license"),
        F.col("similarity").alias(f"{key}_similarity"),
    )
    passed = inherited.select(
        F.col("directory").alias(folder), F.col("license").alias(f"{folder}_license"),
        F.col("from_directory").alias(f"{folder}_from"),
    )
    keyed = files.withColumns(
        {key: F.md5(content.cast("binary")), folder: _directory(F.col(f"`{path}`").cast("string"))}
    )
    joined = keyed.join(own, key, "left").join(passed, folder, "left")
    states, inherits = F.col(f"{key}_license"), F.col(f"{folder}_license")
    results = {
        "license": F.coalesce(states, inherits),
        "similarity": F.col(f"{key}_similarity"),
        "origin": F.when(states.isNotNull(), "stated").when(inherits.isNotNull(), "inherited").otherwise("none"),
        "from_directory": F.when(states.isNull(), F.col(f"{folder}_from")),
    }
    kept = with_results(joined, results)
    return kept.drop(key, folder, f"{key}_license", f"{key}_similarity", f"{folder}_license", f"{folder}_from")
