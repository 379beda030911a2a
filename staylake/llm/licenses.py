"""License scans: sparse TF-IDF cosine of lines and token windows to license notices,
then inheritance from the nearest directory above.

Terms are runs of a-z and 0-9 after lower-casing; idf(t) = 1 + ln((1 + N) / (1 + df(t)))
over all N documents and all their terms. Compared with a template of L terms are
every line of every text, and every run of L terms of the whole text, across line
breaks (a shorter text is one run), so a notice need not stand alone on its line.
A unit goes to the template with the largest cosine, at ``least`` or more; a
document takes its best unit's licence, of equal ones the first template's.
A line that several licences of one family share (``SHARED``) only decides the
licence if no template of the family without it reaches ``least``. MIT, BSD and ISC
licences are held whole; the long ones (GPL, LGPL, AGPL, Apache, MPL) by their
titles, which carry the version, and by the notices they ask for.

Few units are compared: a cosine of ``least`` needs shared terms with least**2 of
the template's squared weight. A template's rarest terms, up to a rest of
``LIGHT`` * least**2, are looked up in all lines and in all pairs of adjacent blocks
of L terms; only lines and pairs whose terms reach the share without that rest
are compared, which loses nothing.

A file named like a licence file (LICENSE, LICENCE, COPYING, with any ending)
speaks for its directory. Every file without a licence of its own takes that of
the nearest directory above it that has one: directories, far fewer than files,
are expanded into their ancestors and joined by path; then files are joined to
their directory. Several licence files of one directory: the best score, then
the smallest id.

NULL or empty texts have no licence of their own; a NULL path has no directory.
Repeated rows are answered each. Extra columns are ignored, an empty table
gives an empty result. Only DataFrame functions are used.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.llm.common import saved, whole_text

# ---- fixed values: license notices by SPDX id -------------------------------
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD = ("""Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution. """,
       """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission. """,
       """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""")
TEMPLATES = [
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International License"),
    ("CC0-1.0", "CC0 1.0 Universal Public Domain Dedication"),
    ("GPL-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-2.0", "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    ("GPL-3.0", "under the terms of the GNU General Public License version 3 as published by the Free Software Foundation"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-2.1", "licensed under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-2.1", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
    ("MIT", MIT),
    ("BSD-2-Clause", BSD[0] + BSD[2]),
    ("BSD-3-Clause", BSD[0] + BSD[1] + BSD[2]),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
]
SHARED = {"Redistribution and use in source and binary forms, with or without modification, are permitted"}
LIGHT, BITS = 0.2, 62
BROADCAST_TERMS = 1_000_000
LICENSE_FILE = r"(?i)(^|/)(license|licence|copying)(\.[^/]*)?$"


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def _words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def _inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    names = [x.split(":")[0] for x in schema.split(", ")]
    made = json.dumps([dict(zip(names, r)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(made), f"array<struct<{schema}>>")))


def weights(n_docs: int, df: dict[str, int], templates: list[tuple[str, str]], least: float) -> tuple[list[tuple], list[tuple], list[tuple]]:
    """Unit vectors of the templates (template, term, weight), the terms looked up (template, terms of
    the template, term, bit), and for each template (template, squared weight of every bit, needed)."""
    idf = {t: 1 + math.log((1 + n_docs) / (1 + df.get(t, 0))) for _, text in templates for t in _words(text)}
    vectors, looked, bits = [], [], []
    for number, (_, text) in enumerate(templates):
        vector = {t: n * idf[t] for t, n in Counter(_words(text)).items()}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        rest, share = 1.0, [0.0] * BITS
        for k, t in enumerate(sorted(vector, key=lambda t: (-idf[t], t))):
            w = vector[t] / norm
            vectors.append((number, t, w))
            if rest > LIGHT * least * least:
                looked.append((number, len(_words(text)), t, k % BITS))
                share[k % BITS] += w * w
                rest -= w * w
        bits.append((number, share, least * least - max(rest, 0.0) - 1e-6))
    return vectors, looked, bits


def _own(spark: SparkSession, files: DataFrame, counts: DataFrame, templates: list[tuple[str, str]], least: float) -> DataFrame:
    """The best licence (``own``, ``score``) of each file ``n`` that has one."""
    # document counts of the templates' terms and of all documents (""): a row per term reaches the driver, whatever the input
    vocabulary = sorted({"", *(t for _, x in templates for t in _words(x))})
    df = {r["term"]: r["count"] for r in counts.filter(F.col("term").isin(vocabulary)).collect()}
    n_docs = df.pop("", 0)
    vectors, looked, bits = weights(n_docs, df, templates, least)
    vectors, bits = _inline(spark, vectors, "template:int, term:string, weight:double"), _inline(spark, bits, "template:int, share:array<double>, needed:double")
    terms_looked = sorted({r[2] for r in looked})
    looked = F.broadcast(_inline(spark, looked, "template:int, length:int, term:string, bit:int"))

    # places that share enough: lines (-1 - line), and pairs of adjacent blocks (number of the first)
    lines = F.split("text", "\r\n|\r|\n")
    in_lines = (files.select("n", F.posexplode(lines).alias("line", "said")).select("n", "line", F.explode(terms(F.col("said"))).alias("term"))
                .filter(F.col("term").isin(terms_looked)).join(looked, "term").select("n", "template", "length", (-1 - F.col("line")).alias("at"), "bit"))
    block = F.floor(F.col("pos") / F.col("length")).cast("int")
    in_blocks = (files.select("n", F.posexplode(terms(F.col("text"))).alias("pos", "term")).filter(F.col("term").isin(terms_looked)).join(looked, "term")
                 .select("n", "template", "length", F.explode(F.array(block - 1, block)).alias("at"), "bit").filter("at >= 0"))
    places = (in_lines.unionAll(in_blocks).groupBy("n", "template", "length", "at").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("met"))
              .join(F.broadcast(bits), "template")
              .filter(F.expr("aggregate(transform(share, (x, k) -> if(shiftright(met, k) & 1L = 1L, x, 0D)), 0D, (a, x) -> a + x) >= needed"))
              .select("n", "template", "length", "at"))
    gathered = saved(places.groupBy("n").agg(F.collect_list(F.struct("template", "length", "at")).alias("places")), "license-places")
    met = (files.select("n", "text").join(gathered, "n").select("n", lines.alias("lines"), terms(F.col("text")).alias("all"), F.explode("places").alias("p"))
           .select("n", "p.*", F.when(F.col("p.at") < 0, terms(F.get("lines", -1 - F.col("p.at"))))
                   .otherwise(F.slice("all", F.greatest(F.lit(0), F.col("p.at")) * F.col("p.length") + 1, 2 * F.col("p.length"))).alias("said")))
    # a line is one unit; a pair has the runs that begin in its first block, a text shorter than the template is one
    size = F.when((F.col("at") < 0) | ((F.col("at") == 0) & (F.size("said") < F.col("length"))), F.size("said")).otherwise(F.col("length"))
    met = saved(met.withColumn("size", size).filter("size(said) >= size"), "license-units")
    begin = F.explode(F.sequence(F.lit(0), F.least(F.size("said") - F.col("size"), F.greatest(F.lit(0), F.col("size") - 1))))
    unit = ["n", "template", "at", "begin"]
    value = (met.select("*", begin.alias("begin")).select(*unit, F.explode(F.slice("said", F.col("begin") + 1, F.col("size"))).alias("term"))
             .groupBy(*unit, "term").agg(F.count("*").alias("tf")))
    used = saved(counts.join(met.select(F.explode("said").alias("term")).distinct(), "term")
                 .select("term", (1 + F.log((1 + F.lit(n_docs)) / (1 + F.col("count")))).alias("idf")), "license-idf")
    if used.count() <= BROADCAST_TERMS:
        used = F.broadcast(used)
    value = (value.join(used, "term").join(F.broadcast(vectors), ["template", "term"], "left")
             .withColumn("value", F.col("tf") * F.col("idf")))
    named = _inline(spark, [(i, lic, lic.split("-")[0], text in SHARED) for i, (lic, text) in enumerate(templates)],
                    "template:int, licence:string, family:string, shared:boolean")
    cosine = (value.groupBy(*unit).agg(F.sum(F.col("value") * F.coalesce("weight", F.lit(0.0))).alias("dot"), F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))
              .withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).filter(F.col("score") >= least).join(F.broadcast(named), "template"))
    best = F.struct("score", (-F.col("template")).alias("t"), "licence")
    of_family = cosine.groupBy("n", "family").agg(F.max(best).alias("b"), F.max(F.when(~F.col("shared"), best)).alias("whole"))
    return (of_family.groupBy("n").agg(F.max(F.struct("b.score", "b.t", F.coalesce("whole.licence", "b.licence").alias("licence"))).alias("b"))
            .select("n", F.col("b.licence").alias("own"), "b.score"))


def scan(docs: DataFrame, path_col: str = "path", id_col: str = "doc_id", text: str = "text", least: float = 0.7,
         templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per document: ``id``, ``path``, ``own`` licence and its ``score``, the ``inherited``
    licence with the directory it comes ``inherited_from``, and the ``licence`` that holds."""
    spark = docs.sparkSession
    # written once: read again from any other plan, the rows would get other numbers
    files = saved(docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(path_col).cast("string").alias("path"), whole_text(text).alias("text"),
                              F.monotonically_increasing_id().alias("n")), "license-input")
    if templates:
        counts = saved(files.select(F.explode(F.array_distinct(F.concat(F.array(F.lit("")), terms(F.col("text"))))).alias("term"))
                       .groupBy("term").count(), "license-terms")
        own = _own(spark, files, counts, templates, least)
    else:
        own = files.select("n", F.lit(None).cast("string").alias("own"), F.lit(None).cast("double").alias("score")).limit(0)
    known_files = files.select("n", "id", "path").join(own, "n", "left").withColumn("directory", F.regexp_extract("path", "^(?s:(.*))/", 1))
    known_files = saved(known_files, "license-files")
    speaks = (known_files.filter(F.col("path").rlike(LICENSE_FILE) & F.col("own").isNotNull())
              .groupBy("directory").agg(F.max(F.struct("score", (-F.col("id")).alias("i"), F.col("own").alias("licence"))).alias("b"))
              .select(F.col("directory").alias("ancestor"), "b.licence"))
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    nearest = (known_files.select("directory").filter("directory IS NOT NULL").distinct().withColumn("ancestor", F.explode(F.array_distinct(above)))
               .join(speaks, "ancestor").groupBy("directory")
               .agg(F.max(F.struct(F.length("ancestor").alias("depth"), "ancestor", "licence")).alias("b"))
               .select("directory", F.col("b.licence").alias("inherited"), F.col("b.ancestor").alias("inherited_from")))
    return (known_files.join(nearest, "directory", "left")
            .select("id", "path", "own", "score", "inherited", "inherited_from", F.coalesce("own", "inherited").alias("licence")))
