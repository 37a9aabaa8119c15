"""Licence scan: sparse TF-IDF cosine to templates, inheritance from ancestor directories.

Every line of a file that bears a mark of a licence statement is a vector of TF-IDF term
weights, compared with a template's by cosine. A statement may also stand among other words
or run over lines: a window of a template's length slides over the file's terms, and words
that are not the template's weigh in it what they displace, however large the table is. The
longest statement found, else the best line at or above a threshold, is the file's own
licence. A licence file speaks for its directory: a file without a licence
of its own takes that of the nearest ancestor directory with one. Directories and their
ancestors meet in joins on paths, of distinct directories only.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import Scratch

#: Licence statements by SPDX identifier.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in "
                   "compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-1.0-or-later", "This program is free software: you can redistribute it and/or modify it under the "
                         "terms of the GNU General Public License"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("Proprietary", "All rights reserved."),
]
#: A line bears a mark of a licence statement.
MARK = r"(?i)licen[cs]|copyright|\(c\) |rights reserved|permission|redistribut|public domain|\bcc[ -]?(by|0)"
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)([._-].*)?$"
#: Least cosine of a file's own licence; least share of its words in the statement for a
#: file to be a licence file whatever its name.
THRESHOLD = 0.6
COVERAGE = 0.5
#: Least share of a template in a window of its length; one of fewer than LONG terms must
#: be there whole.
STATEMENT = 0.9
LONG = 20


def terms(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", text.lower())


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9]+(?:[.-][a-z0-9]+)*)"), F.lit(1))


_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
          "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
          "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
          "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
          "following conditions: The above copyright notice and this permission notice shall be included in all "
          "copies or substantial portions of the Software.")
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
          "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.")
_NO_NAME = (" 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
            "promote products derived from this software without specific prior written permission.")


def _gnu(kind: str, version: str) -> str:
    """The standard header of a GNU licence."""
    return (f"is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public "
            "License as published by the Free Software Foundation, either version "
            f"{version} of the License, or (at your option) any later version.")


#: Standard headers, short licence texts, openings of long ones and SPDX tags.
#: They count as whole statements only; lines are compared with TEMPLATES.
HEADERS = [
    ("MIT", _GRANT), ("MIT", f"{_GRANT} {_AS_IS}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    *[(f"{name}GPL-{version if '.' in version else version + '.0'}", _gnu(kind, version)) for name, kind, version in (
        ("", "General", "2"), ("", "General", "3"), ("L", "Lesser General", "2.1"), ("L", "Lesser General", "3"),
        ("A", "Affero General", "3"))],
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", _BSD), ("BSD-3-Clause", _BSD + _NO_NAME),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"), ("EPL-1.0", "Eclipse Public License - v 1.0"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, "
             "and to alter it and redistribute it freely, subject to the following restrictions"),
    ("BSL-1.0", "Boost Software License - Version 1.0"),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
                  "source code form or as a compiled binary, for any purpose"),
    *[(spdx, f"SPDX-License-Identifier: {spdx}{end}") for spdx, ends in {
        **dict.fromkeys(("MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "ISC", "EPL-1.0", "EPL-2.0",
                         "Unlicense", "Zlib", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
                         "CC-BY-ND-4.0"), ("",)),
        **dict.fromkeys(("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"), ("", "-only", "-or-later")),
        "GPL-1.0-or-later": ("",)}.items() for end in ends],
]
STATEMENTS = TEMPLATES + HEADERS
VOCABULARY = sorted({t for _, text in STATEMENTS for t in terms(text)})


def inverse_frequency(files: DataFrame, text_col: str = "text") -> dict[str, float]:
    """idf of the templates' terms over the whole texts of all files, and of an unseen term
    under ''. Only as many counts as the templates have terms reach the driver."""
    vocabulary = F.split(F.lit(" ".join(VOCABULARY)), " ")
    own = files.select(F.array_intersect(_terms(F.coalesce(text_col, F.lit(""))), vocabulary).alias("t"))
    n = files.count()
    df = {r["term"]: r["n"] for r in own.select(F.explode("t").alias("term")).groupBy("term").agg(
        F.count("*").alias("n")).collect()}
    idf = {t: math.log((n + 1) / (df.get(t, 0) + 1)) + 1 for t in VOCABULARY}
    return idf | {"": math.log(n + 1) + 1}


def prepare(idf: dict[str, float]) -> list[tuple[str, int, list[tuple[str, int, float]]]]:
    """(spdx, number of terms, (term, count, weight of one)) of the statements; the weights of a
    statement add up to 1, as the products of its cosine with itself do."""
    out = []
    for spdx, text in STATEMENTS:
        own = terms(text)
        tf = {t: own.count(t) for t in own}
        norm = sum((c * idf[t]) ** 2 for t, c in tf.items())
        out.append((spdx, len(own), [(t, c, c * idf[t] ** 2 / norm) for t, c in sorted(tf.items())]))
    return out


def statement(words: list[str], prepared: list) -> tuple[str, float, int] | None:
    """(spdx, share, number of terms) of the longest statement in a file's terms."""
    at: dict[str, list[int]] = {}
    known = {t for _, _, own in prepared for t, _, _ in own}
    for i, t in enumerate(words):
        if t in known:
            at.setdefault(t, []).append(i)
    n, best = len(words), None
    for k, (spdx, size, own) in enumerate(prepared):
        need = (STATEMENT if size >= LONG else 1.0) - 1e-9
        share = sum(w * min(len(at.get(t, ())), c) for t, c, w in own)
        if share >= need and n > size:  # the whole file has it: is it in one window?
            got = np.zeros(n - size + 1)
            for t, c, w in own:
                seen = np.zeros(n + 1, np.int64)
                seen[np.array(at.get(t, ()), np.int64) + 1] = 1
                seen = np.cumsum(seen)
                got += w * np.minimum(seen[size:] - seen[:n - size + 1], c)
            share = float(got.max())
        if share >= need and (best is None or (share * size, share) > best[0]):
            best = (share * size, share), (spdx, round(min(share, 1.0), 9), size)
    return best and best[1]


def _find_statements(idf: dict[str, float]):
    def find(batches):
        prepared = prepare(idf)
        for batch in batches:
            keys, rows = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = terms(text.as_py())
                got = statement(words, prepared)
                if got:
                    keys.append(key)
                    rows.append((*got[:2], min(1.0, got[2] / len(words))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(
                    (pa.string(), pa.float64(), pa.float64())))], ["key", "spdx", "share", "part"])
    return find


def own_licenses(files: DataFrame, scratch: Scratch, threshold: float = THRESHOLD) -> DataFrame:
    """(key, license, score, coverage) of the files (key, text) with a licence of their own."""
    idf = inverse_frequency(files)
    rows = []
    for k, (spdx, text) in enumerate(TEMPLATES):
        tf = {t: terms(text).count(t) for t in terms(text)}
        norm = math.sqrt(sum((c * idf[t]) ** 2 for t, c in tf.items()))
        rows += [(k, spdx, t, c * idf[t] / norm) for t, c in sorted(tf.items())]
    spark = files.sparkSession
    template = spark.createDataFrame(rows, "template int, spdx string, term string, w double")
    weight = spark.createDataFrame([(t, v) for t, v in idf.items() if t], "term string, idf double")
    total = F.size(_terms("text"))
    lines = files.select("key", F.filter(F.split("text", "\n"), lambda x: x.rlike(MARK)).alias("l"), "text").where(
        F.size("l") > 0).select("key", total.alias("total"), F.posexplode("l").alias("line", "body"))
    # one row per marked line and term; templates and their terms are fixed tables. Repeated
    # rows share a key: they scale tf, which the cosine takes out, and not the line's words.
    counts = lines.select("key", "total", "line", F.size(_terms("body")).alias("words"),
                          F.explode(_terms("body")).alias("term")).groupBy(
        "key", "total", "line", "words", "term").agg(F.count("*").alias("tf"))
    counts = scratch.keep(counts, "license-terms")
    weighed = counts.join(F.broadcast(weight), "term", "left").withColumn(
        "x", F.col("tf") * F.coalesce("idf", F.lit(idf[""])))
    norms = weighed.groupBy("key", "line").agg(
        F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"), F.max("words").alias("words"))
    dots = weighed.join(F.broadcast(template), "term").groupBy("key", "total", "line", "spdx", "template").agg(
        F.sum(F.col("x") * F.col("w")).alias("dot"))
    scored = dots.join(norms, ["key", "line"]).select(
        "key", "spdx", "template", "line", F.round(F.col("dot") / F.col("norm"), 9).alias("score"),
        (F.col("words") / F.col("total")).alias("coverage")).where(F.col("score") >= threshold)
    best = F.max(F.struct("score", (-F.col("template")).alias("t"), (-F.col("line")).alias("n"), "spdx", "coverage"))
    line = scored.groupBy("key").agg(best.alias("b")).select("key", "b.spdx", "b.score", "b.coverage")
    found = files.where(F.col("text").rlike(MARK)).select("key", "text").mapInArrow(
        _find_statements(idf), "key long, spdx string, share double, part double").groupBy("key").agg(
        F.max(F.struct("share", "spdx", "part")).alias("s")).select(
        "key", F.col("s.spdx").alias("stated"), "s.share", "s.part")
    return line.join(found, "key", "full").select(
        "key", F.coalesce("stated", "spdx").alias("license"), F.coalesce("score", "share").alias("score"),
        F.coalesce("share", "score").alias("match"),
        F.greatest("part", "coverage").alias("coverage"))


def parent(path: Column) -> Column:
    """The directory of a path; '' is the root."""
    return F.regexp_replace(F.regexp_replace(path, "[^/]*$", ""), "/+$", "")


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", id_col: str = "doc_id",
         threshold: float = THRESHOLD, coverage: float = COVERAGE) -> DataFrame:
    """(id, path, own_license, score, license, license_dir) per row of ``files``.

    ``own_license`` is that of the longest statement in the file, else that of its best line;
    ``score`` is the best line's cosine, or the statement's share where no line reaches the
    threshold. A file is a licence file when its name says so or its licence line or statement
    holds at least ``coverage`` of its terms. ``license`` is the file's own licence or that of the nearest
    ancestor directory with a licence file (``license_dir``, null for its own); of several in
    one directory the best match (a statement's share, else the cosine) wins, then the least name. Null and empty texts have no
    licence of their own, but inherit; a null path is no directory and inherits nothing. Ties
    between templates go to the earlier one. Repeated rows get equal results. An empty table
    gives an empty result. Other columns are not read.
    """
    scratch = Scratch(files.sparkSession)
    rows = files.select(F.col(id_col).alias("id"), F.col(path_col).alias("path"),
                        F.coalesce(text_col, F.lit("")).alias("text")).withColumn(
        "key", F.xxhash64(F.col("id").cast("string"), "path", "text"))
    own = scratch.keep(own_licenses(rows.select("key", "text"), scratch, threshold), "own")
    narrow = rows.select("key", "id", "path", parent(F.col("path")).alias("dir"))
    known = scratch.keep(narrow.join(own, "key", "left"), "known")
    speaks = known.where("license is not null and path is not null").where(
        (F.col("coverage") >= coverage) | F.regexp_extract("path", "[^/]*$", 0).rlike(LICENSE_FILE))
    spoken = speaks.groupBy("dir").agg(F.min(F.struct((-F.col("match")).alias("s"), "license")).alias("b")).select(
        F.col("dir").alias("up"), F.col("b.license").alias("given"))
    spoken = scratch.keep(spoken, "spoken")
    # each distinct directory with its ancestors, itself and the root included
    parts = F.split("dir", "/")
    dirs = known.where("dir is not null").select("dir").distinct()
    above = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(
        F.slice(parts, F.lit(1), k), "/"))).alias("up")).distinct()
    nearest = above.join(spoken, "up").groupBy("dir").agg(
        F.max(F.struct(F.length("up").alias("depth"), "up", "given")).alias("b")).select(
        "dir", F.col("b.up").alias("up"), F.col("b.given").alias("given"))
    nearest = scratch.keep(nearest, "nearest")
    out = known.join(nearest, "dir", "left").select(
        F.col("id").alias(id_col), "path", F.col("license").alias("own_license"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("license", "given").alias("license"),
        F.when(F.col("license").isNull(), F.col("up")).alias("license_dir"))
    out = scratch.keep(out, "licenses")
    scratch.close(out)
    return out
