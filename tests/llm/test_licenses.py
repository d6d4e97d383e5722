import math

from pyspark.sql import functions as F

from candlewick.llm import licenses

MIT, GPL = licenses.TEXTS["MIT"][0], licenses.TEXTS["GPL-3.0"][0]


def _scan(spark, rows):
    files = spark.createDataFrame(rows, "doc_id long, path string, text string, licence string")
    return {r.doc_id: r for r in licenses.scan(files, F.col("path")).collect()}


def test_headers_files_and_inheritance(spark):
    rows = [
        (1, "a/LICENSE", MIT, "x"),
        (2, "a/b/code.py", "nothing here", None),
        (3, "a/b/c/COPYING.txt", GPL, "x"),
        (4, "a/b/c/d/code.py", "still nothing", None),
        (5, "a/b/c/d/own.py", f"// first line\n// {MIT}\ncode", None),
        (6, "ab/code.py", None, None),
        (7, None, GPL, None),
        (8, "a/b/c", "a file named as a directory", None),
        (9, "top.py", "", None),
    ]
    found = _scan(spark, rows)
    assert {i: (r.licence, r.origin, r.directory) for i, r in found.items()} == {
        1: ("MIT", "own", None), 2: ("MIT", "inherited", "a"), 3: ("GPL-3.0", "own", None), 4: ("GPL-3.0", "inherited", "a/b/c"), 5: ("MIT", "own", None),
        6: (None, "none", None), 7: ("GPL-3.0", "own", None), 8: ("MIT", "inherited", "a"), 9: (None, "none", None),
    }


def test_a_licence_file_at_the_top_covers_everything(spark):
    found = _scan(spark, [(1, "LICENSE", MIT, None), (2, "x/y/z", "text", None), (3, "w", "text", None)])
    assert {i: r.origin for i, r in found.items()} == {1: "own", 2: "inherited", 3: "inherited"} and found[2].directory == ""


def test_long_texts_ties_and_repeated_rows(spark):
    rows = [(1, "p/long.txt", "words " * 60_000 + "\n" + GPL, None), (2, "p/both.txt", f"{GPL}\n{MIT}", None), (2, "p/both.txt", f"{GPL}\n{MIT}", None)]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string, licence string")
    found = sorted(tuple(r)[:5] for r in licenses.scan(files, F.col("path")).collect())
    # Both lines fit exactly; the first by name counts.
    assert found == [(1, "p/long.txt", "GPL-3.0", 1.0, "own"), *[(2, "p/both.txt", "GPL-3.0", 1.0, "own")] * 2]
    assert _scan(spark, []) == {}


def test_cosines_are_those_of_plain_python(spark):
    units = ["released under mit license", "license license mit of things", "GNU general public license version 3 or later"]
    frame = spark.createDataFrame([(k, 0, False, u) for k, u in enumerate(units)], "key long, place int, whole boolean, unit string")
    idf, unknown, vectors = licenses.weights()
    found = {(r.key, r.template): r.cosine for r in licenses.cosines(frame).collect()}
    for k, unit in enumerate(units):
        bag = licenses.terms(unit)
        x = {t: bag.count(t) * idf.get(t, unknown) for t in bag}
        norm = math.sqrt(sum(v * v for v in x.values()))
        for name, vector in enumerate(vectors):
            dot = sum(v * vector.get(t, 0) for t, v in x.items())
            assert abs(found.get((k, name), 0.0) - dot / norm) < 1e-5


def test_no_unit_at_the_threshold_is_left_out(spark):
    texts = [(k, t) for k, t in enumerate([*[x for _, x in licenses.TEMPLATES], "in and of the source code form", "mit der license", " ".join(MIT.split()[1:])])]
    frame = spark.createDataFrame(texts, "key long, text string")
    units = frame.select("key", F.lit(0).alias("place"), F.lit(True).alias("whole"), F.col("text").alias("unit"))
    every = {r.key for r in licenses.cosines(units).where(F.col("cosine") >= licenses.THRESHOLD).collect()}
    assert every <= {r.key for r in licenses.units(frame).collect()}
    words = licenses._words(F.col("unit"))
    bound = licenses._bound(words, licenses._known(words))
    # The bound is never below a cosine, and equal where other words come once.
    bounds = {r.key: r.b for r in units.select("key", bound.alias("b")).collect()}
    for r in licenses.cosines(units).groupBy("key").agg(F.max("cosine").alias("c")).collect():
        assert bounds[r.key] >= r.c - 1e-6
    once = "nowhere heard words beside " + MIT
    (row,) = spark.createDataFrame([(once,)], "unit string").select(bound.alias("b")).collect()
    (best,) = licenses.cosines(spark.createDataFrame([(1, 0, True, once)], "key long, place int, whole boolean, unit string")).agg(F.max("cosine")).collect()
    assert abs(row.b - best[0]) < 1e-5


def test_the_main_path_runs_no_python(spark, sf_dir):
    from candlewick.llm.queries import QUERIES

    plan = QUERIES["op7_license_scan"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


APACHE = """/*
 * Copyright 2021 The Example Authors. All rights reserved.
 *
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */
package example"""
GPL_HEADER = """# widget.py - draws widgets
# Copyright (C) 2019 A. Person
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.
import os"""
MIT_FILE = """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""
BSD_2 = """Copyright (c) 2018, Some Body
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES.
"""
BSD_3 = """
3. Neither the name of Example Inc. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_texts_as_they_occur_in_files(spark):
    """None of these texts is a template."""
    wanted = {
        "MIT License\n\nCopyright 2020\n\nPermission is hereby granted": "MIT",
        MIT_FILE.split("\n\n", 1)[1]: "MIT",
        "// SPDX-License-Identifier: Apache-2.0\nint main() {}": "Apache-2.0",
        "#!/bin/sh\n# SPDX-License-Identifier: GPL-2.0-only\n": "GPL-2.0",
        "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.": "GPL-3.0",
        APACHE: "Apache-2.0",
        GPL_HEADER: "GPL-3.0",
        GPL_HEADER.replace("software: you", "software; you").replace("Foundation, either version 3", "Foundation; either version 2"): "GPL-2.0",
        GPL_HEADER.replace("GNU General", "GNU Affero General"): "AGPL-3.0",
        MIT_FILE: "MIT",
        BSD_2 + BSD_END: "BSD-2-Clause",
        BSD_2 + BSD_3 + BSD_END: "BSD-3-Clause",
        "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.": "MPL-2.0",
        "We publish software under many conditions, with no permission to copy the documentation.": None,
        "See the license of the source code for the terms of use and the version.": None,
        "SPDX-License-Identifier: EUPL-1.2": None,
        "The person obtaining a copy of the files may use them free of charge.": None,
    }
    found = _scan(spark, [(i, f"{i}/f", text, None) for i, text in enumerate(wanted)])
    assert {text[:60]: found[i].licence for i, text in enumerate(wanted)} == {text[:60]: licence for text, licence in wanted.items()}
