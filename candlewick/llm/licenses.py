"""Licence scan: cosine of headers and licence files to licence templates, and inheritance down the directories.

A file's units are its lines, its blocks (between blank lines, or lines with comment marks
only) and its whole text. Templates are titles, notices, standard headers, clauses and identifier lines, several a licence, so that a header is
compared with headers and a licence file's heading or first paragraph with those. Each unit is
compared with every template as a sparse vector of term counts, weighted by how rare the
term is among the templates; a term that no template has counts as the rarest. A unit can
reach the threshold only if it holds one of the telling terms of a template (the other
terms together weigh too little), and if its cosine would when all other words came once. Other units
are left out before their words become rows. A file without a
licence of its own takes that of its nearest directory upwards that has a licence file.

All of it is DataFrame functions: no Python runs on the executors.
"""

import math
import re
from collections.abc import Callable, Iterable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.workspace import written

# Notices, titles, standard headers and clauses of licences, by SPDX identifier.
TEXTS: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "The MIT License (MIT)",
        "MIT License",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Apache License Version 2.0, January 2004",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This program is free software licensed under the GNU General Public License, version 2.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "BSD-2-Clause": (
        "BSD 2-Clause License",
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ),
    "BSD-3-Clause": (
        "BSD 3-Clause License",
        "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission.",
    ),
    "ISC": (
        "ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Mozilla Public License Version 2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "CC-BY-4.0": ("Licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0.", "Creative Commons Attribution 4.0 International Public License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0 Universal.", "Creative Commons CC0 1.0 Universal"),
}
TEMPLATES: list[tuple[str, str]] = [(name, text) for name, texts in TEXTS.items() for text in (*texts, f"SPDX-License-Identifier: {name}")]
"""Every text of every licence, and the line by which files name it."""
# Words too common to tell a licence by.
COMMON = frozenset("a all an and any are as at be but by do for from if in into is it its may not of on one or see so such that the this to under use v was with without you".split())
THRESHOLD = 0.75
FILE_THRESHOLD = 0.8
"""Cosine of the whole text from which a file is a licence file, whatever its name."""
BLANK = r"\n[^\nA-Za-z0-9]*\n"
"""What stands between blocks: lines without a letter or digit, such as blank ones and bare comment marks."""
LICENCE_NAME = r"(?i)^(licen[cs]e|copying|unlicense)([._-].*)?$"


def terms(text: str) -> list[str]:
    return [t for t in re.split("[^a-z0-9]+", text.lower()) if t]


@cache
def weights() -> tuple[dict[str, float], float, list[dict[str, float]]]:
    """Inverse document frequency of every template term, that of any other term, and the templates as unit vectors."""
    bags = [terms(text) for _, text in TEMPLATES]
    idf = {t: math.log((1 + len(bags)) / (1 + sum(t in b for b in bags))) + 1 for t in {t for b in bags for t in b}}
    vectors = []
    for bag in bags:
        raw = {t: bag.count(t) * idf[t] for t in bag}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        vectors.append({t: x / norm for t, x in raw.items()})
    return idf, math.log(1 + len(bags)) + 1, vectors


def telling_terms(threshold: float = THRESHOLD) -> list[str]:
    """Terms one of which every unit at the threshold holds.

    By Cauchy and Schwarz a cosine is at most the length of the template's part that the
    unit shares; the terms of a template that are not listed are shorter together than the threshold.
    Common words and numbers are listed last, if at all.
    """
    found: set[str] = set()
    for vector in weights()[2]:
        rest = sum(x * x for x in vector.values())
        for term in sorted(vector, key=lambda t: (t in COMMON or t.isdigit(), -vector[t], t)):
            if rest < threshold**2 - 1e-9:
                break
            found.add(term)
            rest -= vector[term] ** 2
    return sorted(found)


def _tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    idf, _, vectors = weights()
    by_term = spark.createDataFrame(sorted(idf.items()), "term string, idf double")
    entries = [(t, i, TEMPLATES[i][0], x) for i, v in enumerate(vectors) for t, x in sorted(v.items())]
    by_template = spark.createDataFrame(entries, "term string, template int, licence string, w double")
    return F.broadcast(by_term), F.broadcast(by_template)  # as large as the fixed templates


def units(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``key``, ``place``, ``whole``, ``unit``: the lines, blocks and whole texts that may reach the threshold.

    Files without a telling term are out after one split of their text; of the others only units with such a term are looked at.
    """
    telling = _literal(telling_terms(threshold))
    some = files.where(F.arrays_overlap(_words(F.col("text")), telling))
    parts = F.array_distinct(F.concat(F.split("text", r"\n"), F.split("text", BLANK)))
    split = lambda whole: lambda u: F.struct(F.lit(whole).alias("whole"), u.alias("unit"), _words(u).alias("words"))
    marked = F.concat(F.filter(F.transform(parts, split(False)), lambda u: F.arrays_overlap(u["words"], telling)), F.array(split(True)(F.col("text"))))
    # Behind the explode a unit's words are columns, so they are split and sorted once, however often the bound looks at them.
    prepared = F.transform(marked, lambda u: F.struct(u["whole"], u["unit"], u["words"], _known(u["words"]).alias("known")))
    each = some.select("key", F.posexplode(prepared).alias("place", "u")).select("key", "place", "u.whole", "u.unit", "u.words", "u.known")
    passing = (_reach(F.col("known")) >= threshold**2 - 1e-9) & (_bound(F.col("words"), F.col("known")) >= threshold - 1e-6)
    return each.where(passing).drop("words", "known")


def _known(words: Column) -> Column:
    """Those of the words that some template has, sorted."""
    return F.array_sort(F.filter(words, lambda w: w.isin(*sorted(weights()[0]))))


def _words(text: Column) -> Column:
    return F.split(F.lower(text), "[^a-z0-9]+")


def _by_term(of: Callable[[str, dict[str, float]], float], first: bool = False) -> Column:
    """A map from every template term to its value for each template (behind its idf, if asked); folded once, before the scan."""
    idf, _, vectors = weights()
    rows = {t: [*([idf[t]] if first else []), *[of(t, v) for v in vectors]] for t in sorted(idf)}
    # As one expression: thousands of literals one by one would take the driver longer than the scan.
    return F.expr("map(" + ", ".join(f"'{t}', array({', '.join(f'{x!r}D' for x in row)})" for t, row in rows.items()) + ")")


def _reach(known: Column) -> Column:
    """The largest share of a template's squared length that lies on any of the words; no cosine is above its root."""
    squares, count = _by_term(lambda t, v: v.get(t, 0.0) ** 2), len(TEMPLATES)
    none = F.array_repeat(F.lit(0.0), count)
    return F.array_max(F.aggregate(F.array_distinct(known), none, lambda sums, t: F.zip_with(sums, squares[t], lambda a, b: a + b)))


def _bound(words: Column, known: Column) -> Column:
    """What no cosine of a unit with a template exceeds: its cosine if every word that no template has came once only.

    ``known`` are counted, others only told apart, so a long text costs no row per word.
    """
    unknown, count = weights()[1], len(TEMPLATES)
    by_term = _by_term(lambda t, v: v.get(t, 0.0), first=True)
    present = F.array_distinct(known)
    # In sorted order a term's occurrences lie between its first place and that of the next term.
    starts = F.transform(present, lambda t: F.array_position(known, t))
    ends = F.concat(F.slice(starts, 2, F.size(known) + 1), F.array((F.size(known) + 1).cast("bigint")))
    times = F.zip_with(starts, ends, lambda a, b: b - a)
    counted = F.zip_with(present, times, lambda t, n: F.struct(by_term[t].alias("row"), (n * by_term[t][0]).alias("x")))
    dots = F.aggregate(counted, F.array_repeat(F.lit(0.0), 1 + count), lambda sums, c: F.zip_with(sums, c["row"], lambda a, b: a + c["x"] * b))
    length = F.aggregate(counted, F.lit(0.0), lambda total, c: total + c["x"] * c["x"])
    others = F.size(F.array_remove(F.array_distinct(words), "")) - F.size(present)
    return F.array_max(F.slice(dots, 2, count)) / F.sqrt(length + others * F.lit(unknown**2))


def _literal(texts: Iterable[str]) -> Column:
    return F.split(F.lit(" ".join(texts)), " ")


def cosines(found: DataFrame) -> DataFrame:
    """``key``, ``place``, ``whole``, ``template``, ``licence``, ``cosine`` of every unit with every template that shares a term."""
    by_term, by_template = _tables(found.sparkSession)
    unknown = weights()[1]
    each = found.select("key", "place", "whole", F.explode(_words(F.col("unit"))).alias("term")).where("term != ''")
    counted = each.groupBy("key", "place", "whole", "term").agg(F.count("*").alias("n"))
    weighted = counted.join(by_term, "term", "left").select("key", "place", "whole", "term", (F.col("n") * F.coalesce("idf", F.lit(unknown))).alias("x"))
    norms = weighted.groupBy("key", "place").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = weighted.join(by_template, "term").groupBy("key", "place", "whole", "template", "licence").agg(F.sum(F.col("x") * F.col("w")).alias("dot"))
    return dots.join(norms, ["key", "place"]).select("key", "place", "whole", "template", "licence", F.round(F.col("dot") / F.col("norm"), 6).alias("cosine"))


def _best(of: Column) -> Column:
    """The licence with the largest cosine, of equal ones the first by name."""
    return F.min_by(of, F.struct(-F.col("cosine"), F.col("licence")))


def scan(files: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``path``, ``licence``, ``cosine``, ``origin`` (own, inherited or none), ``directory`` (that a licence was inherited from).

    ``path`` uses slashes. One row per input row; rows alike in id, path and text are
    judged alike. A null or empty text has no licence of its own, a null path no
    directory. Of several licence files in a directory the one with the largest cosine counts,
    of equal ones the first licence by name.
    """
    named = files.select(files[id_col].cast("bigint").alias("doc_id"), path.alias("path"), files[text_col].cast("string").alias("text"))
    directory = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), "")
    keyed = named.select("*", F.xxhash64("doc_id", "path", "text").alias("key"), directory.alias("dir"), F.element_at(F.split("path", "/"), -1).rlike(LICENCE_NAME).alias("named"))
    # The texts are read twice: for the few units that may fit, and for the paths, which stand for the files from here on.
    found = cosines(written(units(keyed, threshold), "licence-units")).where(F.col("cosine") >= threshold)
    keyed = written(keyed.drop("text"), "licence-paths")
    own = found.groupBy("key").agg(_best(F.col("licence")).alias("own"), F.max("cosine").alias("own_cosine"), F.max(F.when(F.col("whole"), F.col("cosine"))).alias("whole_cosine"))
    rows = keyed.join(own, "key", "left")
    is_file = F.col("own").isNotNull() & F.col("dir").isNotNull() & (F.col("named") | (F.coalesce("whole_cosine", F.lit(0.0)) >= FILE_THRESHOLD))
    licensed = rows.where(is_file).select("dir", F.col("own").alias("licence"), F.col("own_cosine").alias("cosine"))
    by_dir = licensed.groupBy("dir").agg(_best(F.col("licence")).alias("licence"), F.max("cosine").alias("cosine"))

    parts = F.split("dir", "/")
    upwards = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.when(i > 0, F.array_join(F.slice(parts, 1, i), "/")).otherwise(F.lit("")))
    dirs = keyed.select("dir").where("dir is not null").distinct()
    ancestors = dirs.select("dir", F.explode(F.array_distinct(upwards)).alias("directory"))
    near = ancestors.join(by_dir.withColumnRenamed("dir", "directory"), "directory")
    nearest = near.groupBy("dir").agg(F.max_by(F.struct("directory", "licence", "cosine"), F.length("directory")).alias("above"))
    joined = rows.join(nearest, "dir", "left")
    inherits = F.col("own").isNull() & F.col("above").isNotNull()
    return joined.select(
        "doc_id",
        "path",
        F.coalesce("own", "above.licence").alias("licence"),
        F.coalesce("own_cosine", "above.cosine").alias("cosine"),
        F.when(F.col("own").isNotNull(), "own").when(inherits, "inherited").otherwise("none").alias("origin"),
        F.when(inherits, F.col("above.directory")).alias("directory"),
    )
