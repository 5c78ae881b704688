"""Licences of files: TF-IDF cosine of notices to templates, then inheritance by directory.

Notices of a text that mentions a licence are its lines that do, each also joined
with the line after it (headers are wrapped), and the whole text. Equal notices
are folded and become sparse TF-IDF rows over the words of the templates, whose
document frequencies are those of the templates: a score depends on the notice
alone, not on how many others there are. Words no template has do not lower the
cosine, but a notice must consist of its template's words to ``COVERAGE``. The
templates are few and fixed and so are broadcast. A file's licence is that of its
best notice of at least ``THRESHOLD``. A file is a licence file by its name, or
if its whole text, whatever its length, consists of the words of a template to
``FILE_COVERAGE``. A file without a licence
inherits from the licence files of the nearest directory on its path that has
any, found by joining the ancestors of each distinct directory. SQL functions only.

Defined results: null texts are empty; texts of any length are weighed whole; a
null path has no directory; rows are reported each, also those that share an id
or a path; ties go to the whole text, then the earlier line, then the template
first in the list; of several licence files in a directory the best match counts,
then the smallest path. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierline.llm.common import stored, whole_text

#: Cosine from which a notice counts, share of its words that its template has, and that share for a whole
#: text to be a licence file whatever its name.
THRESHOLD, COVERAGE, FILE_COVERAGE = 0.72, 0.5, 0.93
#: Into how many keys a directory's files are dealt for the join with its licence.
SALTS = 32
#: What a line must hold to be a header, and names of licence files (fixed values).
MENTIONS = r"(?i)licen[sc]|copyright|spdx|public domain|rights reserved|creative commons|cc by"
FILE_NAMES = r"(?i)(^|/)(licen[sc]e|copying|notice|unlicense)[^/]*$"

#: Licences and the words of their notices and texts (fixed values).
_NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD style license, three clause."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under Creative Commons Attribution CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under Creative Commons Attribution ShareAlike CC BY SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under Creative Commons CC0 1.0 Universal."),
    ("Proprietary", "All rights reserved."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the Software), to deal in the Software without restriction, including without limitation the rights
        to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
        permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS
        IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
        FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
        ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
        CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
        DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
        NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
        the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
        or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY
        THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program."""),
]
#: An identifier in a line; such a line is that notice, and has to be the template's whole.
SPDX = r"(?i)(spdx-license-identifier:[\x20\t]*[a-z0-9.+-]+)"
#: Every licence is also known by its SPDX identifier.
TEMPLATES = [(name, " ".join(text.split())) for name, text in _NOTICES] + [
    (name, f"SPDX-License-Identifier: {name}") for name in dict(_NOTICES) if name != "Proprietary"]


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def directory(path: Column) -> Column:
    """The path without its last part; empty at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def _counted(texts: DataFrame, key: str) -> DataFrame:
    """(key, token, tf) of distinct texts."""
    return (texts.select(key, F.explode(tokens(F.col("notice"))).alias("token"))
            .groupBy(key, "token").agg(F.count("*").alias("tf")))


def _unit(counted: DataFrame, rarity: DataFrame, key: str) -> DataFrame:
    """(key, token, tf, w) of the tokens that templates have, the weights of a key of length one."""
    weighed = counted.join(F.broadcast(rarity), "token").withColumn("w", (1 + F.log("tf")) * F.col("idf"))
    norms = weighed.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighed.join(norms, key).select(key, "token", "tf", (F.col("w") / F.col("norm")).alias("w"))


def match_notices(notices: DataFrame, threshold: float = THRESHOLD, coverage: float = COVERAGE) -> DataFrame:
    """(notice_key, license, similarity, share) of the distinct notices (notice_key, notice) that match a template."""
    spark = notices.sparkSession
    templates = spark.createDataFrame([(i, *t) for i, t in enumerate(TEMPLATES)], "place int, license string, notice string")
    known = _counted(templates, "place")
    rarity = known.groupBy("token").agg((F.log((F.lit(1.0) + len(TEMPLATES)) / (1 + F.count("*"))) + 1).alias("idf"))
    known = _unit(known, rarity, "place").join(templates.select("place", "license"), "place").select(
        "token", "place", "license", F.col("w").alias("known_w"))
    counted = _counted(notices, "notice_key")
    sizes = counted.groupBy("notice_key").agg(F.sum("tf").alias("words"))
    scores = (_unit(counted, rarity, "notice_key").join(F.broadcast(known), "token").groupBy("notice_key", "place", "license")
              .agg(F.round(F.sum(F.col("w") * F.col("known_w")), 6).alias("similarity"), F.sum("tf").alias("held"))
              .join(sizes, "notice_key")
              .filter(F.col("held") >= F.when(F.col("place") < len(_NOTICES), coverage).otherwise(1.0) * F.col("words")))
    share = (F.col("held") / F.col("words")).alias("share")
    best = F.max(F.struct("similarity", (-F.col("place")).alias("first"), "license", share)).alias("best")
    return (scores.groupBy("notice_key").agg(best).select("notice_key", "best.license", "best.similarity", "best.share")
            .filter(F.col("similarity") >= threshold))


def scan(files: DataFrame, id_column: str = "path", path: Column | None = None,
         license_file: Column | None = None, text_column: str = "text") -> DataFrame:
    """One row per row of ``files``: the id, path, license, found, similarity, origin.

    ``found`` is header, file, inherited or none; ``origin`` the licence file
    inherited from. ``license_file`` tells licence files besides those whose whole
    text is a notice, by default by name.
    """
    path = F.col("path") if path is None else path
    named = F.coalesce(F.rlike(path, F.lit(FILE_NAMES)) if license_file is None else license_file, F.lit(False))
    text = whole_text(text_column)
    mentions = lambda value: F.rlike(value, F.lit(MENTIONS))
    lines = F.transform(F.split(text, "\r?\n|\r"), lambda line: F.trim(line))
    pairs = F.zip_with(lines, F.slice(lines, F.lit(2), F.greatest(F.size(lines), F.lit(1))),
                       lambda line, after: F.struct(line.alias("line"), after.alias("after")))
    numbered = F.transform(pairs, lambda x, i: F.struct(i.alias("line"), x["line"].alias("notice"), x["after"].alias("after")))
    single = F.filter(numbered, lambda x: mentions(x["notice"]))
    joined = F.transform(F.filter(single, lambda x: F.coalesce(x["after"], F.lit("")) != ""), lambda x: F.struct(
        x["line"].alias("line"), F.concat(x["notice"], F.lit(" "), x["after"]).alias("notice")))
    identifier = lambda line: F.regexp_extract(line, SPDX, 1)
    alone = F.transform(single, lambda x: F.struct(x["line"].alias("line"), F.when(
        F.rlike(x["notice"], F.lit(SPDX)), identifier(x["notice"])).otherwise(x["notice"]).alias("notice")))
    whole = F.array(F.struct(F.lit(-1).alias("line"), F.trim(text).alias("notice")))
    none = F.array().cast("array<struct<line:int,notice:string>>")
    rows = stored(files.select(
        F.monotonically_increasing_id().alias("tag"), F.col(id_column).alias("id"), path.alias("file"), named.alias("named"),
        F.when(mentions(text), F.concat(whole, alone, joined)).when(named, whole).otherwise(none).alias("notices")), "notices")
    found = (rows.filter(F.size("notices") > 0).select("tag", "file", "named", F.explode("notices").alias("n"))
             .select("tag", "file", "named", "n.line", "n.notice", F.sha2("n.notice", 256).alias("notice_key")))
    notices = stored(found.groupBy("notice_key").agg(F.first("notice").alias("notice")), "distinct-notices")
    matched = (found.join(match_notices(notices), "notice_key")
               .filter((F.col("line") >= 0) | F.col("named") | (F.col("share") >= FILE_COVERAGE)))
    best = F.max(F.struct("similarity", (-F.col("line")).alias("first"), "license")).alias("best")
    own = stored(matched.groupBy("tag", "file", "named").agg(best, F.min("line").alias("line")).select(
        "tag", "file", (F.col("named") | (F.col("line") == -1)).alias("is_license"), "best.license", "best.similarity"), "own-licenses")

    files_of = own.filter("is_license AND file IS NOT NULL").withColumn("dir", directory(F.col("file")))
    least = files_of.groupBy("dir").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "file", "license")).alias("l"))
    given = least.select("dir", F.col("l.file").alias("origin"), F.col("l.license").alias("given"))
    dirs = rows.filter("file IS NOT NULL").select(directory(F.col("file")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    ancestors = F.concat(F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("up"))), F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("up"))))
    nearest = (dirs.select("dir", F.explode(ancestors).alias("a")).select("dir", "a.depth", "a.up")
               .join(given.withColumnRenamed("dir", "up"), "up")
               .groupBy("dir").agg(F.max(F.struct("depth", "origin", "given")).alias("near"))
               .select("dir", "near.origin", "near.given"))
    # Salted, so the files of a directory that holds a third of all are dealt to many tasks.
    salts = F.explode(F.array(*(F.lit(n) for n in range(SALTS)))).alias("salt")
    wide = (rows.join(own.drop("file"), "tag", "left")
            .select("id", "file", "is_license", "license", "similarity", directory(F.col("file")).alias("dir"),
                    F.pmod(F.xxhash64("tag"), F.lit(SALTS)).cast("int").alias("salt"))
            .join(nearest.select("dir", "origin", "given", salts), ["dir", "salt"], "left"))
    inherits = F.col("license").isNull() & F.col("given").isNotNull()
    return wide.select(
        F.col("id").alias(id_column), F.col("file").alias("path"), F.coalesce("license", "given").alias("license"),
        F.when(F.col("license").isNotNull(), F.when(F.col("is_license"), "file").otherwise("header"))
        .when(inherits, "inherited").otherwise("none").alias("found"),
        "similarity", F.when(inherits, F.col("origin")).alias("origin"))
