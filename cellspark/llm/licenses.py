"""Licence scans by Dice coefficient over word bigrams, in DataFrame operations only.

Every line of a text is normalised (lower case, runs of anything but letters and
digits become one blank) and compared with licence notices: with A and B the sets of
word bigrams, dice = 2 |A n B| / (|A| + |B|).  A line can only reach ``min_dice`` with
templates whose number of bigrams is within min_dice / (2 - min_dice) of its own, and
only with those it shares a bigram with: lines outside the sizes of all templates
are dropped before their bigrams are formed, and bigrams meet templates in a hash
join with the (fixed, small) template table.  A notice that is wrapped over several
lines, or stands inside a much longer line, is not found: the SQL of the query fixes
single lines and these templates.

Defined results: a null or empty text has no lines to match; a line of one word has
no bigram and matches nothing; a bigram that repeats in a line counts once; rows with
equal id and text give one result; a line that matches several templates gives one
row for each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Notices by which texts state a licence (SPDX name, wording).
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                "option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Proprietary", "All rights reserved."),
]


def _words(text):
    """Words of a normalised text."""
    plain = F.trim(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", " "))
    return F.split(plain, " ")


def _bigrams(words):
    """The set of bigrams of a word array, empty below two words."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b)))


def template_table(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(template, license, bigrams, size) of the given notices."""
    rows = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template int, license string, text string")
    return rows.withColumn("words", _words("text")).withColumn("bigrams", _bigrams(F.col("words"))).select(
        "template", "license", "bigrams", F.size("bigrams").alias("size"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES,
         min_dice: float = 0.8) -> DataFrame:
    """(id, line, template, license, dice): lines (from 0, cut at \\n) that reach
    ``min_dice`` with a template."""
    spark = docs.sparkSession
    table = template_table(spark, templates)
    reach = (2 - min_dice) / min_dice
    # the templates are a fixed list: bounds of their sizes and word lengths are constants of the query
    sizes = [r["size"] for r in table.select("size").collect()]
    least, most = min(sizes) / reach, max(sizes) * reach
    text = F.col(text_col).cast("string")
    lines = docs.select(F.col(id_col).alias("_id"), F.posexplode(F.split(text, "\n")).alias("line", "_text"))
    # a line of s bigrams has at least s + 1 words, hence s blanks at least: cheap bounds before the words are formed
    lines = lines.where(F.length("_text") >= 2 * least).withColumn("_words", _words("_text"))
    lines = lines.where((F.size("_words") - 1 >= least))
    lines = lines.withColumn("_bigrams", _bigrams(F.col("_words"))).withColumn("_size", F.size("_bigrams")).where(F.col("_size").between(least, most))
    pairs = lines.select("_id", "line", F.xxhash64("_text").alias("_key"), "_size", F.explode("_bigrams").alias("bigram"))
    known = F.broadcast(table.select("template", "license", "size", F.explode("bigrams").alias("bigram")))  # a few hundred rows
    shared = pairs.join(known, "bigram").where((F.col("_size") <= F.col("size") * reach) & (F.col("size") <= F.col("_size") * reach))
    counted = shared.groupBy("_id", "line", "_key", "template", "license", "_size", "size").agg(F.count_distinct("bigram").alias("common"))
    dice = 2 * F.col("common") / (F.col("_size") + F.col("size"))
    return (counted.withColumn("dice", dice).where(F.col("dice") >= min_dice)
            .select(F.col("_id").alias(id_col), F.col("line").cast("long").alias("line"), F.col("template").cast("long").alias("template"),
                    "license", F.round("dice", 6).alias("dice")))


def scan_sql(templates: list[tuple[str, str]] = TEMPLATES, min_dice: float = 0.8) -> str:
    """The same for DuckDB over the table ``documents`` (without the size bounds)."""
    values = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(templates))
    bigrams = "list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))])"
    return f"""
WITH t AS (SELECT template, license, string_split(trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w
           FROM (VALUES {values}) AS v(template, license, text)),
tb AS (SELECT template, license, {bigrams} AS b FROM t),
l0 AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
l1 AS (SELECT doc_id, unnest(range(0, len(lines))) AS line, unnest(lines) AS text FROM l0),
l2 AS (SELECT doc_id, line, text, string_split(trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w FROM l1),
l3 AS (SELECT DISTINCT doc_id, line, text, {bigrams} AS b FROM l2 WHERE len(w) >= 2),
x AS (SELECT doc_id, line, text, len(b) AS n, unnest(b) AS g FROM l3),
y AS (SELECT template, license, len(b) AS m, unnest(b) AS g FROM tb),
z AS (SELECT doc_id, line, text, template, license, n, m, count(*) AS common FROM x JOIN y USING (g) GROUP BY ALL)
SELECT doc_id, CAST(line AS BIGINT) AS line, CAST(template AS BIGINT) AS template, license, round(2.0 * common / (n + m), 6) AS dice
FROM z WHERE 2.0 * common / (n + m) >= {min_dice}"""
