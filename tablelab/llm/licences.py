"""Licence texts by canonical digest.

A text, and each of its lines, is brought to a canonical form: lower case, without copyright lines, equivalent
spellings made one, everything but letters and digits one blank. The SHA-256 of that form is joined with the
digests of known licences made the same way, so a licence is found however it is typed, and never in part.

Defined cases: null and empty texts, and texts that are empty in canonical form, have no licence; a line that
occurs several times counts for each; known licences with equal canonical form are all reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Licence identifiers and the notices that name them.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
]

#: Equivalent spellings after the reduction to words, as (words, form); applied in this order to both sides.
SPELLINGS = [
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("sub licence", "sublicense"),
    ("copyright owner", "copyright holder"),
    ("non commercial", "noncommercial"),
    ("creative commons", "cc"),
    ("attribution noncommercial", "by nc"),
    ("noncommercial", "nc"),
    ("https", "http"),
]

#: Lines that name owners, not terms.
COPYRIGHT_LINE = "^[ \\t]*(copyright |\\(c\\)|©|all rights reserved)"


def canonical(text: Column) -> Column:
    lines = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "\n"), lambda x: ~F.regexp_like(x, F.lit(COPYRIGHT_LINE)))
    out = F.concat(F.lit(" "), F.regexp_replace(F.array_join(lines, "\n"), "[^\\p{L}\\p{N}]+", " "), F.lit(" "))
    out = F.regexp_replace(out, " v ?([0-9])", " version $1")
    for words, form in SPELLINGS:
        out = F.replace(out, F.lit(f" {words} "), F.lit(f" {form} "))
    return F.trim(F.regexp_replace(out, " +", " "))


def known(spark: SparkSession, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """Known licences: license, digest."""
    rows = spark.createDataFrame(notices, "license string, text string")
    return rows.select("license", F.unhex(F.sha2(canonical(F.col("text")), 256)).alias("digest"))


def scan(documents: DataFrame, licences: DataFrame) -> DataFrame:
    """Licences found: doc_id, license, n_lines (lines that are it), whole (the whole text is it)."""
    text = F.coalesce("text", F.lit(""))
    lines = F.transform(F.split(text, "\n"), lambda x: F.struct(x.alias("part"), F.lit(False).alias("whole")))
    # one line alone is the whole text; it is looked up once for each of the two questions
    parts = documents.select("doc_id", F.explode(F.concat(F.array(F.struct(text.alias("part"), F.lit(True).alias("whole"))), lines)).alias("p"))
    forms = parts.select("doc_id", "p.whole", canonical(F.col("p.part")).alias("form")).where("form != ''")
    hits = forms.select("doc_id", "whole", F.unhex(F.sha2("form", 256)).alias("digest")).join(licences, "digest")
    return hits.groupBy("doc_id", "license").agg(F.count_if(~F.col("whole")).alias("n_lines"), F.bool_or("whole").alias("whole"))
