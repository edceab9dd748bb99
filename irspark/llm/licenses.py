"""License scans by sparse TF-IDF and inheritance along directories.

Lines that state a licence are compared with header templates by the cosine of sparse TF-IDF
vectors, with document frequencies counted over all such lines. In a line of more than twice the
terms of the longest template the statement is a part, so there every run of terms as long as a
template, around a stating term, is compared as well. Licence files are compared as a whole with
the bodies of licences too. A file has the licence of its best line or body. A file without one
inherits from the licence file in its nearest ancestor directory.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from irspark.plans.lineage import materialize
from irspark.plans.skew import lookup_join

THRESHOLD = 0.75
# A line must hold one of these to be looked at; every template does.
_STATES = r"(?i)licen[cs]e|copyright|public domain"
# The terms by which a run of terms states a licence.
_STATING_TERM = r"licen[cs]e|copyright|^public$"

# Short licence headers as files carry them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This file is subject to the terms of the Mozilla Public License, version 2.0.",
    "Proprietary": "Copyright. All rights reserved. No license is granted.",
}


# What licence files hold besides names and years. Longer bodies can be passed.
BODIES = {
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT
HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS
BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY
OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF
ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.""",
}


def terms(line: Column) -> Column:
    """Lower-case runs of letters, digits and inner marks, as `by-nc` and `4.0`."""
    return F.regexp_extract_all(F.lower(line), F.lit(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*"), F.lit(0))


def _counted(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, term, tf."""
    return texts.select(key, F.explode(terms(F.col(text))).alias("term")).groupBy(key, "term").agg(
        F.count(F.lit(1)).alias("tf"))


def _runs(t: Column, lengths: list[int]) -> Column:
    """Runs of terms, of the given lengths, that hold a stating term; t has more terms than any length."""
    n = F.size(t)
    at = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get(t, i).rlike(_STATING_TERM))
    around = [
        F.flatten(F.transform(at, lambda i: F.transform(
            F.sequence(F.greatest(F.lit(0), i - (k - 1)), F.least(i, n - k)),
            lambda first: F.array_join(F.slice(t, first + 1, k), " "))))
        for k in lengths
    ]
    return F.array_distinct(F.concat(*around))


def _best(counted: DataFrame, corpus: DataFrame, n: int, templates: DataFrame, order: DataFrame, threshold: float) -> DataFrame:
    """id, license, score, rank of the rows (id, term, tf) of `counted` that are like a template.

    Document frequencies are those of the n rows `corpus` (id, term) and the templates.
    """
    wanted = _counted(templates, "license", "line")
    both = corpus.select("term").unionByName(wanted.select("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = both.select("term", (F.log((1.0 + F.lit(n)) / (1 + F.col("df"))) + 1).alias("idf"))
    known = materialize(wanted.join(idf, "term").select("license", "term", (F.col("tf") * F.col("idf")).alias("w")))
    lengths = known.groupBy("license").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("template_norm"))
    weighed = materialize(counted.join(idf, "term").select("id", "term", (F.col("tf") * F.col("idf")).alias("v")))
    norms = weighed.groupBy("id").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    # The templates' terms are bounded by the given templates.
    dots = weighed.join(F.broadcast(known), "term").groupBy("id", "license").agg(F.sum(F.col("v") * F.col("w")).alias("dot"))
    cosine = F.round(F.col("dot") / (F.col("norm") * F.col("template_norm")), 6)
    scored = dots.join(norms, "id").join(F.broadcast(lengths), "license").select("id", "license", cosine.alias("score"))
    first = F.min_by(F.struct("license", "score", "rank"), F.struct(-F.col("score"), "rank")).alias("first")
    return scored.filter(F.col("score") >= threshold).join(F.broadcast(order), "license").groupBy("id").agg(first).select(
        "id", "first.*")


def _order(spark: SparkSession, *named: Mapping[str, str]) -> DataFrame:
    return spark.createDataFrame([(k, i) for i, k in enumerate(sorted({k for m in named for k in m}))], "license string, rank int")


def stated(files: DataFrame, key: str, text: str, templates: Mapping[str, str] = TEMPLATES,
           threshold: float = THRESHOLD) -> DataFrame:
    """key, license, score of the files with a line like a template; the best line decides.

    Ties go to the first template by name. Every line of the whole text is looked at, of whatever
    length; a long line counts with its best run of terms.
    """
    spark = files.sparkSession
    lines = files.select(F.col(key).alias("_key"), F.posexplode(F.split(text, "\n")).alias("_no", "line"))
    lines = lines.filter(F.col("line").rlike(_STATES))
    given = spark.createDataFrame(sorted(templates.items()), "license string, line string")
    sizes = sorted({r.n for r in given.select(F.size(terms(F.col("line"))).alias("n")).collect()} - {0})
    # Equal lines, and equal runs in them, are scored once.
    distinct = materialize(lines.select("line").distinct().select("line", terms(F.col("line")).alias("t")))
    long = distinct.filter(F.size("t") > 2 * max(sizes))
    parts = materialize(distinct.select("line", F.col("line").alias("unit")).unionByName(
        long.select("line", F.explode(_runs(F.col("t"), sizes)).alias("unit"))).withColumn("id", F.unhex(F.md5("unit"))))
    counted = materialize(_counted(parts.select("id", "unit").dropDuplicates(["id"]), "id", "unit"))
    whole = materialize(distinct.select(F.explode(F.array_distinct("t")).alias("term")))
    n = distinct.filter(F.size("t") > 0).count() + len(templates)
    best = _best(counted, whole, n, given, _order(spark, templates), threshold)
    top_part = F.min_by(F.struct("license", "score", "rank"), F.struct(-F.col("score"), "rank")).alias("top")
    named = materialize(parts.select("id", "line").join(best, "id").groupBy("line").agg(top_part).select("line", "top.*"))
    found = lookup_join(lines, named, ["line"])
    top = F.min_by(F.struct("license", "score"), F.struct(-F.col("score"), "rank", "_no")).alias("top")
    return found.groupBy("_key").agg(top).select(F.col("_key").alias(key), "top.license", "top.score")


def whole_licenses(files: DataFrame, key: str, text: str, bodies: Mapping[str, str] = BODIES,
                   threshold: float = THRESHOLD) -> DataFrame:
    """key, license, score of the files whose whole text is like the body of a licence.

    Null texts and texts without a term are like none; rows of equal keys count as one text.
    """
    spark = files.sparkSession
    given = spark.createDataFrame(sorted(bodies.items()), "license string, line string")
    counted = materialize(_counted(files.select(F.col(key).alias("id"), F.col(text).alias("text")), "id", "text"))
    n = counted.select("id").distinct().count() + len(bodies)
    return _best(counted, counted, n, given, _order(spark, bodies), threshold).select(F.col("id").alias(key), "license", "score")


def scan(files: DataFrame, path: str = "path", text: str = "text", license_file: str = r"(?i)(^|/)(LICEN[CS]E|COPYING)[^/]*$",
         templates: Mapping[str, str] = TEMPLATES, bodies: Mapping[str, str] = BODIES, threshold: float = THRESHOLD) -> DataFrame:
    """path, license, score, origin of every file.

    origin is `own` if a line of the file states the licence or a licence file (its name matches
    `license_file`) holds its body, whichever is more alike, the first name on ties; `inherited` if it comes from the
    licence file of the nearest ancestor directory that has one
    with a stated licence, and null without one. Of several licence files of a directory the first
    by name counts. Files without a path have no ancestors; equal paths share what is stated in
    any of them. Null and empty texts state nothing; an empty table gives an empty one; other
    columns are not read. Directories are joined by level, so a deep or crowded directory makes
    no large group: there is one row per directory that has a licence.
    """
    held = files.select(F.col(path).alias("path"), F.col(text).alias("text"))
    is_license = F.col("path").rlike(license_file)
    either = stated(held, "path", "text", templates, threshold).unionByName(
        whole_licenses(held.filter(is_license), "path", "text", bodies, threshold))
    best = F.min_by(F.struct("license", "score"), F.struct(-F.col("score"), "license")).alias("best")
    own = materialize(either.groupBy("path").agg(best).select("path", "best.*"))
    parent = F.regexp_extract("path", r"(?s)^(.*)/[^/]*$", 1)
    directories = own.filter(is_license).withColumn("directory", parent).groupBy("directory").agg(
        F.min_by("license", "path").alias("from_directory"), F.min_by("score", "path").alias("directory_score"))
    directories = materialize(directories)
    wanting = materialize(held.select("path").join(own.select("path"), "path", "left_anti").filter("path is not null").distinct())
    # Every ancestor directory of a file, the nearest first; the root is the empty path.
    names = F.split("path", "/")
    ancestors = F.transform(F.sequence(F.size(names) - 1, F.lit(0), F.lit(-1)),
                            lambda k: F.array_join(F.slice(names, 1, k), "/"))
    climbed = wanting.select("path", F.posexplode(ancestors).alias("distance", "directory"))
    above = lookup_join(climbed, directories, ["directory"]).groupBy("path").agg(
        F.min_by(F.struct("from_directory", "directory_score"), "distance").alias("above"))
    inherited = above.select("path", F.col("above.from_directory").alias("license"), F.col("above.directory_score").alias("score"),
                             F.lit("inherited").alias("origin"))
    known = materialize(own.withColumn("origin", F.lit("own")).unionByName(inherited))
    return lookup_join(held.select("path"), known.filter("path is not null"), ["path"], "left").select(
        "path", "license", "score", "origin")
