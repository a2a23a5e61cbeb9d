"""Operator 4: licence scan of files (native).

A file's header is the bag of words of all its lines that mention a licence (whole texts
are looked through).  Headers and the templates below become sparse TF-IDF vectors, the
document frequencies counted over all headers and templates.  Besides the header, every
mention line, every run of two or three lines around one and the head block (the lines up
to the first empty one) is a vector by itself, so that other mentions of the file do not
dilute a notice; the template of the highest cosine of at least LEAST to any of them names
the licence.  A licence file (LICENSE*, LICENCE*, COPYING*, NOTICE*, in any case) is first
held against the whole licence texts of licence_texts/, with document frequencies of
these texts; the nearest one names the licence at a cosine of at least WHOLE.  A file without
a licence takes that of the nearest directory on its path that has a licence file with a
licence of its own.  Inheritance is worked out once per directory by joins on path
prefixes, so a directory that holds a third of all files is one row there.

Only Spark expressions run here.  Null and empty texts have no header; a null path has
no directory but the root; several licence files of a directory: the smallest path counts;
rows that repeat are rows of the result.  Ties of templates: the smallest name.  An empty
table gives no rows.  Extra columns are not looked at.

The SQL below knows headers as a whole only: it says the same for files with one mention
line at most, which is what the tables here have.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: licence names and the notices by which files state them
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Use of this source code is governed by a BSD 2-Clause license."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0, dedicated to the public domain."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software under the MIT License."),
    ("MPL-2.0", "This source code form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain under the Unlicense."),
]
MENTION = "(?i)licen[cs]e|copyright|permission is hereby|public domain|spdx"
WORD_BREAK = "[^a-z0-9.+-]+"
LICENCE_FILE = "(?i)^(licen[cs]e|copying|notice)"
LEAST = 0.6
TEXTS = Path(__file__).parent / "licence_texts"      # whole texts, each named by its licence
WHOLE = 0.9                                          # some of the texts are as near to each other; the nearest names the licence


def words(text: Column) -> Column:
    """Words of a text, without full stops and dashes around them."""
    parts = F.transform(F.split(F.lower(text), WORD_BREAK), lambda w: F.regexp_replace(w, "^[.+-]+|[.+-]+$", ""))
    return F.filter(parts, lambda w: w != "")


def header(text: Column) -> Column:
    """The lines of a text that mention a licence, null without any."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(MENTION))
    return F.when(text.rlike(MENTION), F.array_join(lines, " "))


def passages(text: Column) -> Column:
    """The header of a text, each mention line, the runs of up to three lines that begin or
    end with one, and the head block; the header comes first."""
    def found(ls: Column) -> Column:
        cut = lambda lo, n: F.array_join(F.slice(ls, lo, n), " ")  # noqa: E731  lo counts from 1
        at = F.filter(F.sequence(F.lit(1), F.size(ls)), lambda i: F.element_at(ls, i).rlike(MENTION))
        runs = F.transform(at, lambda i: F.array(cut(i, F.lit(1)), cut(i, F.lit(2)), cut(i, F.lit(3)),
                                                 cut(F.greatest(i - 1, F.lit(1)), F.lit(2)), cut(F.greatest(i - 2, F.lit(1)), F.lit(3))))
        return F.flatten(runs)
    head = F.regexp_extract(text, r"^(?s:\s*(.*?))(\n[ \t\r]*\n|\z)", 1)
    # a lambda variable holds the lines, so that they are cut once per text
    lines = F.transform(F.array(F.split(text, "\n")), found)
    return F.array_distinct(F.concat(F.array(header(text)), F.element_at(lines, 1), F.when(head.rlike(MENTION), F.array(head)).otherwise(F.array())))


def header_cosines(files: DataFrame, row: str, text: str, least: float = LEAST) -> DataFrame:
    """row, licence and cosine of the rows with a passage that is near enough to a template."""
    spark: SparkSession = files.sparkSession
    heads = (files.where(F.col(text).rlike(MENTION))
             .select(F.col(row).alias("row"), F.posexplode(passages(F.col(text))).alias("part", "h")))
    tf = heads.select("row", "part", F.explode(words(F.col("h"))).alias("w")).groupBy("row", "part", "w").agg(F.count(F.lit(1)).alias("tf"))
    whole = tf.where(F.col("part") == 0)                                            # the headers
    fixed = spark.createDataFrame([(i, name, t) for i, (name, t) in enumerate(TEMPLATES)], "t int, licence string, notice string")
    t_tf = fixed.select("t", "licence", F.explode(words(F.col("notice"))).alias("w")).groupBy("t", "licence", "w").agg(F.count(F.lit(1)).alias("tf"))
    n = whole.select("row").distinct().count() + len(TEMPLATES)
    df = (whole.select("w").unionAll(t_tf.select("w"))).groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    weight = F.col("tf") * (F.log(F.lit(1.0 + n) / (1.0 + F.coalesce("df", F.lit(0)))) + 1.0)
    vec = tf.join(df, "w", "left").select("row", "part", "w", weight.alias("x"))    # lines beside a mention have words of no header
    t_vec = t_tf.join(df, "w").select("t", "licence", "w", weight.alias("y"))       # some hundred rows
    return nearest_templates(vec, t_vec, least)


def nearest_templates(vec: DataFrame, t_vec: DataFrame, least: float) -> DataFrame:
    """row, licence and cosine of the template nearest to any part of a row, from the weights
    x of (row, part, w) and y of (t, licence, w)."""
    t_vec = F.broadcast(t_vec.join(t_vec.groupBy("t").agg(F.sqrt(F.sum(F.col("y") * F.col("y"))).alias("t_norm")), "t"))
    norm = vec.groupBy("row", "part").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dot = vec.join(t_vec, "w").groupBy("row", "part", "t", "licence", "t_norm").agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
    cosine = F.round(F.col("dot") / (F.col("norm") * F.col("t_norm")), 4)
    best = F.min(F.struct((-cosine).alias("minus"), "licence"))
    return (dot.join(norm, ["row", "part"]).where(cosine >= least).groupBy("row").agg(best.alias("b"))
            .select("row", F.col("b.licence").alias("licence"), (-F.col("b.minus")).alias("cosine")))


def whole_text_cosines(files: DataFrame, row: str, text: str) -> DataFrame:
    """row, licence and cosine of the rows whose text is one of the whole licence texts."""
    spark: SparkSession = files.sparkSession
    texts = [(i, f.stem, f.read_text("utf-8")) for i, f in enumerate(sorted(TEXTS.glob("*.txt")))]
    fixed = spark.createDataFrame(texts, "t int, licence string, notice string")
    t_tf = fixed.select("t", "licence", F.explode(words(F.col("notice"))).alias("w")).groupBy("t", "licence", "w").agg(F.count(F.lit(1)).alias("tf"))
    df = F.broadcast(t_tf.groupBy("w").agg(F.count(F.lit(1)).alias("df")))          # some thousand rows
    tf = (files.where(F.col(text).rlike(MENTION)).select(F.col(row).alias("row"), F.lit(0).alias("part"), F.explode(words(F.col(text))).alias("w"))
          .groupBy("row", "part", "w").agg(F.count(F.lit(1)).alias("tf")))
    weight = F.col("tf") * (F.log(F.lit(1.0 + len(texts)) / (1.0 + F.coalesce("df", F.lit(0)))) + 1.0)
    vec = tf.join(df, "w", "left").select("row", "part", "w", weight.alias("x"))
    return nearest_templates(vec, t_tf.join(df, "w").select("t", "licence", "w", weight.alias("y")), WHOLE)


def scan(files: DataFrame, path: str = "path", text: str = "text", least: float = LEAST, keep: tuple[str, ...] = ()) -> DataFrame:
    """path, licence, cosine, origin (header, inherited or none), from_path and the columns ``keep``: one row per file."""
    base = files.select(F.coalesce(F.col(path).cast("string"), F.lit("")).alias("__path"), F.col(text).cast("string").alias("__text"),
                        *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)], F.monotonically_increasing_id().alias("__row"))
    name = F.regexp_extract("__path", "([^/]*)$", 1)
    stating = whole_text_cosines(base.where(name.rlike(LICENCE_FILE)), "__row", "__text")
    own = (header_cosines(base, "__row", "__text", least).join(stating.select("row", F.struct("licence", "cosine").alias("s")), "row", "full")
           .select("row", F.coalesce("s.licence", "licence").alias("licence"), F.coalesce("s.cosine", "cosine").alias("cosine")))
    folder = F.regexp_replace("__path", "/?[^/]*$", "")
    rows = base.drop("__text").withColumn("__dir", folder).join(own, F.col("__row") == F.col("row"), "left").drop("row")
    stated = (rows.where(F.col("licence").isNotNull() & name.rlike(LICENCE_FILE)).groupBy(F.col("__dir").alias("at"))
              .agg(F.min(F.struct("__path", "licence")).alias("s"))
              .select("at", F.col("s.__path").alias("from_path"), F.col("s.licence").alias("theirs")))
    parts = F.split("__dir", "/")
    # every directory with all directories above it, the root (an empty path) too
    above = (rows.select("__dir").distinct()
             .select("__dir", F.explode(F.sequence(F.lit(0), F.when(F.col("__dir") == "", 0).otherwise(F.size(parts)))).alias("depth"))
             .select("__dir", "depth", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/").alias("at")))
    nearest = (above.join(stated, "at").groupBy("__dir").agg(F.max(F.struct("depth", "from_path", "theirs")).alias("s"))
               .select(F.col("__dir").alias("d"), F.col("s.from_path").alias("from_path"), F.col("s.theirs").alias("theirs")))
    got = rows.join(nearest, F.col("__dir") == F.col("d"), "left")
    has = F.col("licence").isNotNull()
    return got.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], F.col("__path").alias("path"),
                      F.coalesce("licence", "theirs").alias("licence"), "cosine",
                      F.when(has, "header").when(F.col("theirs").isNotNull(), "inherited").otherwise("none").alias("origin"),
                      F.when(~has, F.col("from_path")).alias("from_path"))


def document_paths(docs: DataFrame) -> DataFrame:
    """Documents as files: source/language/thousand/hundred/name; each tenth is a licence
    file of its directory."""
    number = F.coalesce("doc_id", F.lit(-1))
    k = lambda n: F.call_function("div", number, F.lit(n).cast("long")).cast("string")
    name = F.when(F.pmod(number, F.lit(10)) == 0, F.concat(F.lit("LICENSE-"), number.cast("string"))).otherwise(F.concat(number.cast("string"), F.lit(".txt")))
    folder = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), k(1000), k(100))
    return docs.withColumn("path", F.concat_ws("/", folder, name))


def scan_documents(docs: DataFrame) -> DataFrame:
    return scan(document_paths(docs.select("doc_id", "text", "lang", "source")), keep=("doc_id",))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def oracle(documents: str = "documents", least: float = LEAST) -> str:
    """The same in DuckDB SQL."""
    fixed = ", ".join(f"({i}, {_quoted(name)}, {_quoted(t)})" for i, (name, t) in enumerate(TEMPLATES))
    parts = lambda t: (f"list_filter(list_transform(string_split_regex(lower({t}), {_quoted(WORD_BREAK)}), "  # noqa: E731
                       "lambda w: regexp_replace(w, '^[.+-]+|[.+-]+$', '', 'g')), lambda w: w <> '')")
    return f"""
WITH files AS (
  SELECT row_number() OVER () AS row, doc_id, text,
         source || '/' || lang || '/' || CAST(doc_id // 1000 AS VARCHAR) || '/' || CAST(doc_id // 100 AS VARCHAR) AS dir,
         CASE WHEN doc_id % 10 = 0 THEN 'LICENSE-' || CAST(doc_id AS VARCHAR) ELSE CAST(doc_id AS VARCHAR) || '.txt' END AS name
  FROM {documents}),
heads AS (
  SELECT row, array_to_string(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, {_quoted(MENTION)})), ' ') AS h
  FROM files WHERE regexp_matches(text, {_quoted(MENTION)})),
tf AS (SELECT row, w, count(*) AS tf FROM (SELECT row, unnest({parts('h')}) AS w FROM heads) GROUP BY ALL),
notices(t, licence, notice) AS (VALUES {fixed}),
t_tf AS (SELECT t, licence, w, count(*) AS tf FROM (SELECT t, licence, unnest({parts('notice')}) AS w FROM notices) GROUP BY ALL),
n AS (SELECT count(DISTINCT row) + {len(TEMPLATES)} AS n FROM tf),
df AS (SELECT w, count(*) AS df FROM (SELECT w FROM tf UNION ALL SELECT w FROM t_tf) GROUP BY w),
idf AS (SELECT w, ln((1.0 + (SELECT n FROM n)) / (1.0 + df)) + 1.0 AS idf FROM df),
vec AS (SELECT row, w, tf * idf AS x FROM tf JOIN idf USING (w)),
t_vec AS (SELECT t, licence, w, tf * idf AS y FROM t_tf JOIN idf USING (w)),
t_norm AS (SELECT t, sqrt(sum(y * y)) AS t_norm FROM t_vec GROUP BY t),
norm AS (SELECT row, sqrt(sum(x * x)) AS norm FROM vec GROUP BY row),
cosines AS (
  SELECT row, licence, round(sum(x * y) / (any_value(norm) * any_value(t_norm)), 4) AS cosine
  FROM vec JOIN t_vec USING (w) JOIN t_norm USING (t) JOIN norm USING (row) GROUP BY row, t, licence),
own AS (
  SELECT row, licence, cosine FROM cosines WHERE cosine >= {least}
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY cosine DESC, licence) = 1),
stated AS (
  SELECT dir AS place, min(struct_pack(path := dir || '/' || name, licence := licence)) AS s
  FROM files JOIN own USING (row) WHERE name LIKE 'LICENSE%' GROUP BY dir),
above AS (
  SELECT dir, k AS depth, array_to_string(list_slice(string_split(dir, '/'), 1, k), '/') AS place
  FROM (SELECT DISTINCT dir FROM files), (SELECT unnest(range(0, 5)) AS k)),
nearest AS (
  SELECT dir, s FROM above JOIN stated USING (place)
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY depth DESC) = 1)
SELECT f.doc_id, f.dir || '/' || f.name AS path, coalesce(o.licence, (n.s).licence) AS licence, o.cosine,
       CASE WHEN o.licence IS NOT NULL THEN 'header' WHEN n.s IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN o.licence IS NULL THEN (n.s).path END AS from_path
FROM files f LEFT JOIN own o USING (row) LEFT JOIN nearest n ON f.dir = n.dir
"""
