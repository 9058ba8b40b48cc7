"""License scans: headers and licence files against templates, then inheritance down the directories. DataFrame functions alone.

The licence lines of every whole text are its header. What may be a statement becomes a sparse TF-IDF vector (document
frequencies are those of all headers and templates): the header, each licence sentence in it, and, so that a holder's name, a year or
prose around a statement does not hide it, each run of words as long as a template whose licence word lies where the template has
one, over line ends too. The best cosine with a template counts, and from THRESHOLD on it is the row's own licence. A run of words is
left out early only where the template words in it cannot reach THRESHOLD, whatever else it holds. A row without one inherits that of the nearest ancestor
directory, its own included, that holds a licence file; of several such files in a directory the highest
cosine counts, then the smallest id.

Null and empty texts have no header and may inherit. A null path lies in the root directory ''. Ties between
templates go to the first name. Null ids and repeated rows are kept. An empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.5
# What makes a line a licence line, what a licence file is called, and what licences say.
LINE = r"(?i)licen[cs]e|copyright|spdx-|all rights reserved|permission is hereby granted|creative commons|public domain"
FILE = r"(?i)^(licen[cs]e|copying|unlicense)"
WORD = r"[a-z0-9][a-z0-9.+-]*[a-z0-9]|[a-z0-9]"
SENTENCE_END = r"(?<=[.;!?])\s+|\n"
LICENCE_WORD = r"licen[cs]e|copyright|spdx-|^(reserved|granted|commons|domain)$"
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "Copyright. All rights reserved."),
]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def header(text: Column) -> Column:
    """The licence lines of a text as one string; null where there is none."""
    return F.when(text.rlike(LINE), F.array_join(F.filter(F.split(text, "\n"), lambda line: line.rlike(LINE)), "\n"))


def spans() -> list[tuple[str, int, int]]:
    """(template, its number of words, place of a licence word in it) of all licence words of TEMPLATES; places count from 1, and place 0 stands for the template as a whole."""
    out = []
    for i, (name, says) in enumerate(TEMPLATES):
        found = re.findall(WORD, says.lower())
        out += [(f"{name}#{i}", len(found), at) for at in [0, *(j for j, word in enumerate(found, 1) if re.search(LICENCE_WORD, word))]]
    return out


def pieces(header: Column, said: Column) -> Column:
    """What may be a statement, as array<struct<words, at>>: the header and its licence sentences (at 0), and the words around each licence word of all words said, itself at place at."""
    whole = F.array_distinct(F.concat(F.array(header), F.filter(F.split(header, SENTENCE_END), lambda s: s.rlike(LINE))))
    most = max(n for _, n, _ in spans())
    start = lambda i: F.greatest(i - most + 2, F.lit(1))  # noqa: E731  i counts from 0
    around = F.transform(said, lambda word, i: F.when(word.rlike(LICENCE_WORD), F.struct(F.slice(said, start(i), 2 * most - 1).alias("words"), (i + 2 - start(i)).alias("at"))))
    return F.concat(F.transform(whole, lambda s: F.struct(words(s).alias("words"), F.lit(0).alias("at"))), F.filter(around, lambda x: x.isNotNull()))


def directory(path: Column) -> Column:
    return F.coalesce(F.regexp_extract(path, r"^(.*)/[^/]*$", 1), F.lit(""))


def scan(files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row of files: id, directory, own_license, cosine, license, found_in (the directory it comes from; null if there is no licence)."""
    spark = files.sparkSession
    path = F.coalesce(F.col(path_col).cast("string"), F.lit(""))
    rows = files.select(
        F.col(id_col).alias("id"), directory(path).alias("directory"), F.regexp_extract(path, r"([^/]*)$", 1).rlike(FILE).alias("is_file"), header(F.col(text_col).cast("string")).alias("header"), F.col(text_col).cast("string").alias("text"),
    ).withColumn("row", F.monotonically_increasing_id())
    said = rows.where("header is not null").select("row", "header", pieces(F.col("header"), words(F.col("text"))).alias("pieces"))
    templates = spark.createDataFrame([(f"{name}#{i}", says) for i, (name, says) in enumerate(TEMPLATES)], "template string, says string").coalesce(1)
    frequencies = lambda df, key, text: df.select(key, F.explode(words(F.col(text))).alias("word")).groupBy(key, "word").agg(F.count(F.lit(1)).alias("tf"))
    of_rows, of_templates = frequencies(said, "row", "header"), frequencies(templates, "template", "says")
    df = of_rows.select("word").unionByName(of_templates.select("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    total = said.agg((F.count(F.lit(1)) + len(TEMPLATES)).alias("n"))
    idf = df.crossJoin(F.broadcast(total)).select("word", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf"))  # n is one row
    known = of_templates.join(idf, "word").withColumn("weight", F.col("tf") * F.col("idf"))
    known = known.join(known.groupBy("template").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm")), "template").select("word", "template", (F.col("weight") / F.col("norm")).alias("part"))
    parts = known.groupBy("template").agg(F.map_from_entries(F.collect_list(F.struct("word", "part"))).alias("parts"))
    places = spark.createDataFrame(spans(), "template string, n int, place int").coalesce(1).join(parts, "template")  # of TEMPLATES, as parts are
    tried = said.select("row", F.posexplode("pieces").alias("piece", "found")).join(F.broadcast(places), (F.col("found.at") > 0) == (F.col("place") > 0))
    before = F.col("found.at") - F.col("place")  # words before the template's first one; negative where the text starts later than that
    window = F.slice("found.words", F.greatest(before + 1, F.lit(1)), F.greatest(F.col("n") + F.least(before, F.lit(0)), F.lit(0)))
    tried = tried.select("row", "piece", "place", "template", "parts", F.when(F.col("place") > 0, window).otherwise(F.col("found.words")).alias("words"))
    reach = F.aggregate(F.array_intersect(F.map_keys("parts"), "words"), F.lit(0.0), lambda total, word: total + F.col("parts")[word] * F.col("parts")[word])
    of_pieces = tried.where(F.sqrt(reach) >= threshold - 0.001).select("row", "piece", "place", "template", "parts", "words", F.explode(F.array_distinct("words")).alias("word"))
    of_pieces = of_pieces.select("row", "piece", "place", "template", "word", F.col("parts")[F.col("word")].alias("part"), F.size(F.filter("words", lambda w: w == F.col("word"))).alias("tf"))
    unseen = F.log(F.col("n") + 1) + 1  # the idf of words around a header that no header holds
    weighed = of_pieces.join(idf, "word", "left").crossJoin(F.broadcast(total)).withColumn("weight", F.col("tf") * F.coalesce("idf", unseen))
    cosines = weighed.groupBy("row", "piece", "place", "template").agg(F.round(F.sum(F.col("weight") * F.col("part")) / F.sqrt(F.sum(F.col("weight") ** 2)), 4).alias("cosine"))
    scored = cosines.where(F.col("cosine") >= threshold)
    best = scored.groupBy("row").agg(F.min(F.struct((-F.col("cosine")).alias("minus"), "template")).alias("best")).select("row", F.substring_index("best.template", "#", 1).alias("own_license"), (-F.col("best.minus")).alias("cosine"))
    owned = rows.drop("header", "text").join(best, "row", "left")
    held = owned.where("is_file and own_license is not null").groupBy("directory").agg(F.min(F.struct((-F.col("cosine")).alias("minus"), "id", "own_license")).alias("best"))
    held = held.select(F.col("directory").alias("ancestor"), F.col("best.own_license").alias("inherited"))
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    ancestors = rows.select("directory").distinct().select("directory", F.explode(F.array_union(F.array(F.lit("")), above)).alias("ancestor"))
    nearest = ancestors.join(held, "ancestor").groupBy("directory").agg(F.max(F.struct(F.length("ancestor").alias("depth"), "ancestor", "inherited")).alias("near"))
    out = owned.join(nearest, "directory", "left")
    return out.select(
        F.col("id").alias(id_col), "directory", "own_license", "cosine", F.coalesce("own_license", "near.inherited").alias("license"),
        F.when(F.col("own_license").isNotNull(), F.col("directory")).otherwise(F.col("near.ancestor")).alias("found_in"),
    )


def document_paths(docs: DataFrame) -> DataFrame:
    """documents with a path: the source, then two levels of directories by id; texts that open with a licence line are licence files."""
    source, n = F.coalesce("source", F.lit("unknown")), F.coalesce("doc_id", F.lit(0))
    text = lambda c: c.cast("string")
    folder = F.when(n % 256 == 0, source).when(n % 16 == 0, F.concat_ws("/", source, text(F.floor(n / 256)))).otherwise(F.concat_ws("/", source, text(F.floor(n / 256)), text(F.floor(n / 16))))
    name = F.when(F.substring_index("text", "\n", 1).rlike(LINE), F.lit("LICENSE-")).otherwise(F.lit("text-"))
    return docs.select("doc_id", "text", F.concat(folder, F.lit("/"), F.coalesce(name, F.lit("text-")), text(n)).alias("path"))


def sql() -> str:
    values = ", ".join(f"('{name}#{i}', '{says}')" for i, (name, says) in enumerate(TEMPLATES))
    return rf"""
WITH rows AS (
  SELECT doc_id, CASE WHEN doc_id % 256 = 0 THEN source WHEN doc_id % 16 = 0 THEN concat_ws('/', source, doc_id // 256) ELSE concat_ws('/', source, doc_id // 256, doc_id // 16) END AS directory,
    regexp_matches(split_part(text, chr(10), 1), '{LINE}') AS is_file, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{LINE}')) AS lines
  FROM documents
), words AS (
  SELECT doc_id::VARCHAR AS id, unnest(regexp_extract_all(lower(array_to_string(lines, chr(10))), '{WORD}')) AS word FROM rows WHERE len(lines) > 0
  UNION ALL SELECT template, unnest(regexp_extract_all(lower(says), '{WORD}')) FROM (VALUES {values}) t(template, says)
), tf AS (SELECT id, word, count(*) AS tf FROM words GROUP BY ALL
), idf AS (SELECT word, ln(((SELECT count(*) FROM rows WHERE len(lines) > 0) + {len(TEMPLATES)} + 1) / (count(*) + 1)) + 1 AS idf FROM tf GROUP BY word
), weights AS (SELECT id, word, tf * idf AS weight FROM tf JOIN idf USING (word)
), norms AS (SELECT id, sqrt(sum(weight * weight)) AS norm FROM weights GROUP BY id
), dots AS (
  SELECT a.id, b.id AS template, sum(a.weight * b.weight) AS dot FROM weights a JOIN weights b USING (word)
  WHERE contains(b.id, '#') AND NOT contains(a.id, '#') GROUP BY ALL
), scored AS (SELECT d.id, d.template, round(d.dot / a.norm / b.norm, 4) AS cosine FROM dots d JOIN norms a ON a.id = d.id JOIN norms b ON b.id = d.template
), best AS (SELECT id, template, cosine FROM scored WHERE cosine >= {THRESHOLD} QUALIFY row_number() OVER (PARTITION BY id ORDER BY cosine DESC, template) = 1
), owned AS (SELECT r.doc_id, r.directory, r.is_file, split_part(b.template, '#', 1) AS own_license, b.cosine FROM rows r LEFT JOIN best b ON b.id = r.doc_id::VARCHAR
), held AS (SELECT directory, own_license FROM owned WHERE is_file AND own_license IS NOT NULL QUALIFY row_number() OVER (PARTITION BY directory ORDER BY cosine DESC, doc_id) = 1
), near AS (
  SELECT o.doc_id, h.directory AS ancestor, h.own_license AS inherited FROM owned o JOIN held h ON o.directory = h.directory OR starts_with(o.directory, h.directory || '/')
  QUALIFY row_number() OVER (PARTITION BY o.doc_id ORDER BY length(h.directory) DESC) = 1
)
SELECT o.doc_id, o.directory, o.own_license, o.cosine, coalesce(o.own_license, n.inherited) AS license, CASE WHEN o.own_license IS NOT NULL THEN o.directory ELSE n.ancestor END AS found_in
FROM owned o LEFT JOIN near n USING (doc_id)
"""
