"""Licence scans: sparse TF-IDF cosine to template statements, inherited along directories.

A file is cut into sentences; those with a term of the templates are compared
with every template by the cosine of their term weights.  A directory has the
licence of its best licence file, and a file without a licence of its own has
that of the nearest directory above it that has one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verdance.session import materialise

# Statements by which licences are named.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License version 3"),
    ("GPL-2.0", "licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("MPL-2.0", "subject to the terms of the Mozilla Public License, version 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "dedicated to the public domain under CC0 1.0 Universal"),
)
STOP_TERMS = "a an and any are be by can except for in is it may not of or the this to under with without you"
TERM = "[a-z0-9]+(?:[.][0-9]+)?"
SENTENCE_END = r"[.;!?][\x20\x09-\x0D]+|[\n\r]"
LICENSE_FILE = "^(LICEN[CS]E|COPYING|UNLICENSE|NOTICE)"
LEAST_COSINE = 0.7
DIGITS = 6


def _literals(rows: Sequence[tuple[str, str]]) -> str:
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)


def terms(text: Column) -> Column:
    """Terms of a text, repeated ones too; stop terms are left out."""
    stops = F.array(*[F.lit(t) for t in STOP_TERMS.split()])
    found = F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), F.lit(1))
    return F.filter(found, lambda t: ~F.array_contains(stops, t))


def template_weights(spark: SparkSession, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``template, license, term, weight, idf``: unit vectors of the templates, some rows each."""
    # Bounded by the list of templates, which is a parameter.
    rows = spark.sql(f"SELECT * FROM VALUES {_literals(templates)} AS t(license, body)")
    numbered = rows.distinct().withColumn("template", F.row_number().over(W.orderBy("license", "body")))
    split = numbered.select("template", "license", F.explode(terms(F.col("body"))).alias("term"))
    tf = split.groupBy("template", "license", "term").agg(F.count("*").alias("tf"))
    every = tf.select("template").distinct().agg(F.count("*").alias("n"))
    n = every.first()["n"]
    idf = tf.groupBy("term").agg((F.log((1 + F.lit(n)) / (1 + F.count("*"))) + 1).alias("idf"))
    raw = tf.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("template")))
    return raw.select("template", "license", "term", (F.col("w") / norm).alias("weight"), "idf", F.lit(n).alias("n"))


def own_licenses(files: DataFrame, weights: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """``file_id, license, score`` of files with a sentence whose cosine is ``least`` or more.

    The best sentence counts; ties go to the first licence by name.  Terms
    that no template has weigh like the rarest.
    """
    vocabulary = weights.select("term", "idf", "n").distinct().collect()  # bounded by the templates
    known = F.array(*[F.lit(t) for t in sorted({r["term"] for r in vocabulary})])
    n = vocabulary[0]["n"]
    rarest = F.log(F.lit(1.0 + n)) + 1
    sentences = F.filter(
        F.transform(F.split(F.coalesce("text", F.lit("")), SENTENCE_END), terms),
        lambda t: F.arrays_overlap(t, known),
    )
    found = files.select("file_id", F.posexplode(sentences).alias("place", "terms"))
    tf = (
        found.select("file_id", "place", F.explode("terms").alias("term"))
        .groupBy("file_id", "place", "term").agg(F.count("*").alias("tf"))
    )
    idf = weights.select("term", "idf").distinct()
    weighted = tf.join(F.broadcast(idf), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", rarest))
    # A window over the terms of a sentence, so that the texts are read once.
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("file_id", "place")))
    dots = (
        weighted.withColumn("norm", norm)
        .where("idf is not null")
        .join(F.broadcast(weights.select("template", "license", "term", "weight")), "term")
        .groupBy("file_id", "place", "template", "license")
        .agg(F.sum(F.col("w") * F.col("weight")).alias("dot"), F.max("norm").alias("norm"))
    )
    scored = dots.withColumn("score", F.round(F.col("dot") / F.col("norm"), DIGITS))
    best = F.min(F.struct((-F.col("score")).alias("minus"), F.col("license").alias("license")))
    return (
        scored.where(F.col("score") >= least)
        .groupBy("file_id").agg(best.alias("best"))
        .select("file_id", "best.license", (-F.col("best.minus")).alias("score"))
    )


def directory(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def ancestors(path: Column) -> Column:
    """The directory and all above it, with the number of their parts; the root has none."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda k: F.struct(F.array_join(F.slice(parts, 1, k), "/").alias("above"), k.alias("depth")),
    )


def license_scan(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``file_id, own_license, own_score, license, license_dir`` per row of ``file_id, path, text``.

    ``license_dir`` is NULL for a licence of the file's own.  A missing text
    has no licence; a missing path has no directory and inherits nothing.
    Directories are resolved first, one row each, so a directory with many
    files costs no more than another until the last join.
    """
    spark = files.sparkSession
    # Used three times below; written, it is found once.
    own = materialise(own_licenses(files, template_weights(spark, templates)), "licenses")
    placed = files.select("file_id", "path").join(own, "file_id", "left").withColumn("dir", directory(F.col("path")))
    name = F.regexp_extract("path", "([^/]*)$", 1)
    best = F.min(F.struct((-F.col("score")).alias("minus"), F.col("path").alias("path"), F.col("license").alias("license")))
    of_dir = (
        placed.where(F.col("license").isNotNull() & name.rlike(LICENSE_FILE))
        .groupBy(F.col("dir").alias("above")).agg(best.alias("best"))
        .select("above", F.col("best.license").alias("dir_license"))
    )
    dirs = placed.select("dir").where("dir is not null").distinct()
    nearest = F.max(F.struct("depth", "above", "dir_license"))
    resolved = (
        dirs.select("dir", F.inline(ancestors(F.col("dir"))))
        .join(of_dir, "above")
        .groupBy("dir").agg(nearest.alias("near"))
        .select("dir", F.col("near.dir_license").alias("dir_license"), F.col("near.above").alias("license_dir"))
    )
    return placed.join(resolved, "dir", "left").select(
        "file_id",
        F.col("license").alias("own_license"),
        F.col("score").alias("own_score"),
        F.coalesce("license", "dir_license").alias("license"),
        F.when(F.col("license").isNull(), F.col("license_dir")).alias("license_dir"),
    )


SHORT_FILE = 300


def files_of(docs: DataFrame) -> DataFrame:
    """Documents as files: directories by source, language and number, short ones as licence files."""
    top = F.concat(F.lit("/"), F.coalesce("source", F.lit("none")))
    mid = F.concat(top, F.lit("/"), F.coalesce("lang", F.lit("none")))
    low = F.concat(mid, F.lit("/"), F.floor(F.col("doc_id") / 64).cast("string"))
    depth = F.pmod(F.col("doc_id"), F.lit(4))
    short = F.coalesce(F.length("text"), F.lit(0)) < SHORT_FILE
    name = F.when(short, F.concat(F.lit("LICENSE."), F.col("doc_id"))).otherwise(F.concat(F.col("doc_id"), F.lit(".txt")))
    folder = F.when(short & (depth == 0), top).when(short & (depth == 1), mid).otherwise(low)
    return docs.select(F.col("doc_id").alias("file_id"), F.concat(folder, F.lit("/"), name).alias("path"), "text")


def license_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return license_scan(files_of(docs)).withColumnRenamed("file_id", "doc_id")


_STOP_SQL = ", ".join(f"'{t}'" for t in STOP_TERMS.split())


def _terms_sql(text: str) -> str:
    return f"list_filter(regexp_extract_all(lower({text}), '{TERM}'), lambda t: t NOT IN ({_STOP_SQL}))"


LICENSE_SQL = rf"""
WITH given AS (SELECT * FROM (VALUES {_literals(TEMPLATES)}) AS t(license, body)
), numbered AS (
  SELECT row_number() OVER (ORDER BY license, body) AS template, license, {_terms_sql('body')} AS terms FROM given
), t_tf AS (
  SELECT template, license, term, count(*) AS tf FROM (SELECT template, license, unnest(terms) AS term FROM numbered) GROUP BY ALL
), t_idf AS (
  SELECT term, ln((1 + (SELECT count(*) FROM numbered)) / (1 + count(*))) + 1 AS idf FROM t_tf GROUP BY term
), t_raw AS (
  SELECT template, license, term, tf * idf AS w FROM t_tf JOIN t_idf USING (term)
), weights AS (
  SELECT template, license, term, w / sqrt(sum(w * w) OVER (PARTITION BY template)) AS weight FROM t_raw
), files AS (
  SELECT doc_id, text,
    CASE WHEN coalesce(length(text), 0) < {SHORT_FILE} AND doc_id % 4 = 0 THEN '/' || source
      WHEN coalesce(length(text), 0) < {SHORT_FILE} AND doc_id % 4 = 1 THEN '/' || source || '/' || lang
      ELSE '/' || source || '/' || lang || '/' || (doc_id // 64) END AS dir,
    CASE WHEN coalesce(length(text), 0) < {SHORT_FILE} THEN 'LICENSE.' || doc_id ELSE doc_id || '.txt' END AS name
  FROM documents
), sentences AS (
  SELECT doc_id, place, {_terms_sql('s')} AS terms
  FROM (SELECT doc_id, unnest(range(len(parts))) AS place, unnest(parts) AS s
        FROM (SELECT doc_id, string_split_regex(coalesce(text, ''), '{SENTENCE_END}') AS parts FROM files))
), tf AS (
  SELECT doc_id, place, term, count(*) AS tf FROM (SELECT doc_id, place, unnest(terms) AS term FROM sentences) GROUP BY ALL
), weighted AS (
  SELECT doc_id, place, term, tf * coalesce(idf, ln(1.0 + (SELECT count(*) FROM numbered)) + 1) AS w
  FROM tf LEFT JOIN t_idf USING (term)
), norms AS (
  SELECT doc_id, place, sqrt(sum(w * w)) AS norm FROM weighted GROUP BY ALL
), scored AS (
  SELECT doc_id, place, template, license, round(sum(weighted.w * weight) / any_value(norm), {DIGITS}) AS score
  FROM weighted JOIN weights USING (term) JOIN norms USING (doc_id, place) GROUP BY ALL
), own AS (
  SELECT doc_id, license, score FROM scored WHERE score >= {LEAST_COSINE}
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) = 1
), placed AS (
  SELECT f.doc_id, f.dir, f.name, own.license, own.score FROM files f LEFT JOIN own USING (doc_id)
), of_dir AS (
  SELECT dir AS above, license AS dir_license FROM placed
  WHERE license IS NOT NULL AND regexp_matches(name, '{LICENSE_FILE}')
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, dir || '/' || name) = 1
), resolved AS (
  SELECT dir, dir_license, above AS license_dir
  FROM (SELECT DISTINCT dir FROM placed) d JOIN of_dir ON d.dir = above OR starts_with(d.dir, above || '/')
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY length(above) DESC) = 1
)
SELECT doc_id, license AS own_license, score AS own_score, coalesce(license, dir_license) AS license,
  CASE WHEN license IS NULL THEN license_dir END AS license_dir
FROM placed LEFT JOIN resolved USING (dir)
"""
