"""License scans by diagonal voting.

Templates are license notices, names of licenses and their SPDX identifiers.  Every
run of k words of every text is hashed; those whose hash a template has are joined to
its places, verified word by word, and vote for the diagonal (place in text - place in
template) that they lie on.  Neighbouring diagonals of a template, apart by a few
inserted or lost words, are merged into spans.

A phrase counts when all its words stand consecutively, a notice when verified hits
cover at least COVER of its words.

Texts are read once: what is kept of a row is its number, its count of words and, for
the runs that a template may have, place and words.  All joins are on that number.

Defined results: a null or empty text has no words and no license.  Repeated
rows and ids get results of their own.  Texts are read whole; hits, not
texts, are shuffled.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHORT, LONG = 2, 4   # words hashed together in phrases and in notices
PHRASE = 4           # templates of up to so many words are phrases anyway
COVER = 0.6          # share of a notice's words that makes it found
DRIFT = 8            # words a notice may have gained or lost between two hits
GAP = 40             # words of a text between two hits of one span


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False
    phrase: bool = False    # all words, consecutively, however many there are

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(SPLIT, self.text.translate(str.maketrans(UPPER, LOWER))) if w]

    @property
    def exact(self) -> bool:
        return self.phrase or len(self.words) <= PHRASE

    @property
    def k(self) -> int:
        return LONG if len(self.words) >= LONG else min(SHORT, len(self.words))


# Base phrases of the contract, license names, and the wording of
# well-known public notices.
TEMPLATES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by", "creative commons attribution"),
    Template("bsd", "bsd license"),
    Template("isc", "isc license"),
    Template("mpl", "mozilla public license"),
    Template("lgpl", "lesser general public license"),
    Template("agpl", "affero general public license"),
    Template("rights-reserved", "all rights reserved"),
    Template("mit-text", """Permission is hereby granted, free of charge, to any person obtaining
        a copy of this software and associated documentation files (the "Software"), to deal in the
        Software without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software."""),
    Template("apache-notice", """Licensed under the Apache License, Version 2.0 (the "License"); you
        may not use this file except in compliance with the License. You may obtain a copy of the
        License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
        agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the
        License for the specific language governing permissions and limitations under the
        License."""),
    Template("gpl-notice", """This program is free software: you can redistribute it and/or modify
        it under the terms of the GNU General Public License as published by the Free Software
        Foundation, either version 3 of the License, or (at your option) any later version. This
        program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
        See the GNU General Public License for more details."""),
    Template("bsd-text", """Redistribution and use in source and binary forms, with or without
        modification, are permitted provided that the following conditions are met:
        Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution."""),
    Template("isc-text", """Permission to use, copy, modify, and/or distribute this software for any
        purpose with or without fee is hereby granted, provided that the above copyright notice and
        this permission notice appear in all copies."""),
    Template("mpl-notice", """This Source Code Form is subject to the terms of the Mozilla Public
        License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain
        one at http://mozilla.org/MPL/2.0/."""),
    Template("bsd-3-clause-text", """Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without
        specific prior written permission."""),
    Template("as-is-text", """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS
        IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""),
    Template("unlicense-text", """This is free and unencumbered software released into the public
        domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this
        software, either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means."""),
    Template("boost-text", """Permission is hereby granted, free of charge, to any person or
        organization obtaining a copy of the software and accompanying documentation covered by this
        license (the "Software") to use, reproduce, display, distribute, execute, and transmit the
        Software, and to prepare derivative works of the Software, and to permit third-parties to
        whom the Software is furnished to do so."""),
    Template("zlib-text", """This software is provided 'as-is', without any express or implied
        warranty. In no event will the authors be held liable for any damages arising from the use
        of this software. Permission is granted to anyone to use this software for any purpose,
        including commercial applications, and to alter it and redistribute it freely."""),
    Template("lgpl-notice", """This library is free software; you can redistribute it and/or modify it
        under the terms of the GNU Lesser General Public License as published by the Free Software
        Foundation; either version 2.1 of the License, or (at your option) any later version."""),
    Template("agpl-notice", """This program is free software: you can redistribute it and/or modify it
        under the terms of the GNU Affero General Public License as published by the Free Software
        Foundation, either version 3 of the License, or (at your option) any later version."""),
    Template("cc0-text", """To the extent possible under law, the person who associated CC0 with this
        work has waived all copyright and related or neighboring rights to this work."""),
)

# Names that are in use for licenses, and their SPDX identifiers.
NAMES = {
    "agpl": ("agplv3", "gnu agpl"),
    "apache": ("apache 2.0", "apache software license"),
    "artistic": ("artistic license",),
    "boost": ("boost software license",),
    "bsd": ("bsd licensed",),
    "bsd-2-clause": ("bsd 2-clause", "simplified bsd", "freebsd license"),
    "bsd-3-clause": ("bsd 3-clause", "new bsd", "modified bsd"),
    "cc0": ("cc0", "creative commons zero"),
    "epl": ("eclipse public license",),
    "gpl": ("gnu gpl", "gplv2", "gplv3", "gpl v2", "gpl v3", "gpl license"),
    "lgpl": ("gnu lgpl", "lgplv2", "lgplv3"),
    "mit": ("mit licensed",),
    "mpl": ("mplv2",),
    "unlicense": ("unlicense",),
    "wtfpl": ("wtfpl",),
    "zlib": ("zlib license",),
}
SPDX = {
    "agpl": ("AGPL-3.0",), "apache": ("Apache-2.0",), "artistic": ("Artistic-2.0",), "boost": ("BSL-1.0",),
    "bsd-2-clause": ("BSD-2-Clause",), "bsd-3-clause": ("BSD-3-Clause",), "cc0": ("CC0-1.0",),
    "cc-by": ("CC-BY-4.0", "CC-BY-3.0"), "cc-by-sa": ("CC-BY-SA-4.0", "CC-BY-SA-3.0"), "epl": ("EPL-2.0",),
    "gpl": ("GPL-2.0", "GPL-3.0"), "isc": ("ISC",), "lgpl": ("LGPL-2.1", "LGPL-3.0"), "mit": ("MIT",),
    "mpl": ("MPL-2.0",), "unlicense": ("Unlicense",), "zlib": ("Zlib",),
}
TEMPLATES += tuple(Template(label, name, phrase=True) for label, names in NAMES.items() for name in names)
TEMPLATES += tuple(Template(label, f"SPDX-License-Identifier: {i}", phrase=True)
                   for label, ids in SPDX.items() for i in ids)


def read_templates(files: dict[str, str]) -> tuple[Template, ...]:
    """Templates of whole license texts: label → path of a text file on the driver."""
    return tuple(Template(label, Path(path).read_text("utf-8", "replace"))
                 for label, path in files.items())


def words(text: Column) -> Column:
    """Words of a text: A-Z in lower case, split at ASCII other than 0-9 and a-z."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(low, SPLIT), "")


def _pairs(a: Column, ahead: int) -> Column:
    """Hash of each element with the one ``ahead`` places on."""
    return F.zip_with(a, F.slice(a, ahead + 1, F.greatest(F.size(a), F.lit(1))),
                      lambda x, y: F.xxhash64(x, y))


def _hashes(df: DataFrame, w: str) -> DataFrame:
    """Adds ``h1``, ``h2`` and ``h4``: hashes of the runs of 1, SHORT and LONG words."""
    return (df.withColumn("h1", F.transform(w, lambda x: F.xxhash64(x)))
            .withColumn("h2", _pairs(F.col("h1"), 1)).withColumn("h4", _pairs(F.col("h2"), 2)))


def _places(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(h, t, k, at, ws): the templates' runs; as many rows as templates have words."""
    rows = [(i, x.k, x.words) for i, x in enumerate(templates)]
    df = _hashes(spark.createDataFrame(rows, "t int, k int, w array<string>"), "w")
    run = F.when(F.col("k") == 1, F.col("h1")).when(F.col("k") == SHORT, F.col("h2")).otherwise(F.col("h4"))
    return (df.select("t", "k", "w", F.posexplode(run).alias("at", "h"))
            .filter(F.col("at") <= F.size("w") - F.col("k"))
            .select("h", "t", "k", "at", F.slice("w", F.col("at") + 1, F.col("k")).alias("ws")))


def _rows(df: DataFrame, key: str, text: str, places: DataFrame) -> DataFrame:
    """(id, key, n_words, runs): one pass over the texts; runs holds (k, pos, h, ws) of the
    runs of words whose hash some template has."""
    known = {k: sorted({r["h"] for r in places.select("k", "h").collect() if r["k"] == k})
             for k in (1, SHORT, LONG)}
    src = _hashes(df.select(F.col(f"`{key}`").alias("key"), words(F.col(f"`{text}`")).alias("w")), "w")
    n = F.size("w")

    def runs(k: int, h: str) -> Column:
        at = F.filter(F.transform(h, lambda x, i: F.when(x.isin(known[k]), i)),
                      lambda i: i.isNotNull() & (i <= n - k))
        return F.transform(at, lambda i: F.struct(F.lit(k).alias("k"), i.alias("pos"), F.get(h, i).alias("h"),
                                                  F.slice("w", i + 1, k).alias("ws")))
    found = F.concat(*[runs(k, h) for k, h in ((1, "h1"), (SHORT, "h2"), (LONG, "h4")) if known[k]])
    return src.select(F.monotonically_increasing_id().alias("id"), "key", n.cast("long").alias("n_words"),
                      found.alias("runs"))


def spans(rows: DataFrame, places: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """(id, t, hits): the candidate spans of every row, hits an array of struct(pos, at)."""
    hits = (rows.select("id", F.inline("runs")).withColumnRenamed("ws", "here")
            # The templates are a parameter of bounded size, so every task gets all of them.
            .join(F.broadcast(places), ["h", "k"]).filter(F.col("here") == F.col("ws")))
    diagonals = (hits.groupBy("id", "t", (F.col("pos") - F.col("at")).alias("d"))
                 .agg(F.sort_array(F.collect_set(F.struct("pos", "at"))).alias("hits")))
    exact = F.col("t").isin([i for i, x in enumerate(templates) if x.exact])
    first, last = F.col("hits")[0]["pos"], F.element_at("hits", -1)["pos"]
    # Diagonals near each other first, so that one far off, of a phrase that the notice
    # repeats, does not come between them; then by place in the text.
    by_d = Window.partitionBy("id", "t").orderBy("d")
    near = Window.partitionBy("id", "t", "near").orderBy(first, "d")
    so_far = F.max(last).over(near.rowsBetween(Window.unboundedPreceding, -1))

    def numbered(apart: Column, order) -> Column:
        return F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(order)
    diagonals = stored(diagonals, "diagonals")     # read twice, and small beside the texts
    merged = (diagonals.filter(~exact)
              .withColumn("apart", F.col("d") - F.lag("d").over(by_d) > DRIFT)
              .withColumn("near", numbered(F.col("apart"), by_d))
              .withColumn("apart", first - so_far > GAP)
              .withColumn("part", numbered(F.col("apart"), near))
              .groupBy("id", "t", "near", "part")
              .agg(F.flatten(F.collect_list("hits")).alias("hits")).drop("near", "part"))
    return diagonals.filter(exact).drop("d").unionByName(merged)


def _per_template(values: list, kind: str) -> Column:
    return F.array(*[F.lit(v).cast(kind) for v in values])


def licenses(df: DataFrame, key: str = "doc_id", text: str = "text",
             templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """key, n_words and ``found``: array of struct(t, first, last, cover), the
    spans of templates found; first and last are word numbers."""
    places = _places(df.sparkSession, templates)
    rows = stored(_rows(df, key, text, places), "license_rows")
    k = _per_template([t.k for t in templates], "int")[F.col("t")]
    size = _per_template([len(t.words) for t in templates], "int")[F.col("t")]
    least = _per_template([1.0 if t.exact else COVER for t in templates], "double")[F.col("t")]
    covered = F.flatten(F.transform("hits", lambda h: F.sequence(h["at"], h["at"] + k - 1)))
    measured = spans(rows, places, templates).select(
        "id", "t", F.array_min(F.transform("hits", lambda h: h["pos"])).alias("first"),
        (F.array_max(F.transform("hits", lambda h: h["pos"])) + k - 1).alias("last"),
        (F.size(F.array_distinct(covered)) / size).alias("cover")).filter(F.col("cover") >= least)
    found = measured.groupBy("id").agg(F.collect_list(F.struct("t", "first", "last", "cover")).alias("found"))
    return rows.select("id", "key", "n_words").join(found, "id", "left").select(
        F.col("key").alias(key), "n_words", F.coalesce("found", F.array().cast(
            "array<struct<t:int,first:int,last:int,cover:double>>")).alias("found"))


def summary(found: DataFrame, key: str = "doc_id",
            templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """The verified spans of licenses() as one line a row: places and labels."""
    label = _per_template([t.label for t in templates], "string")
    base = _per_template([t.base for t in templates], "boolean")
    found = found.withColumn("base", F.filter("found", lambda s: base[s["t"]]))

    def labels(spans: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(
            F.transform(spans, lambda s: label[s["t"]]))), ",")

    starts = F.transform("base", lambda s: s["first"])
    return found.select(
        key, "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        labels("base").alias("base_labels"), labels("found").alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda s: s["cover"])), F.lit(0.0))
        .alias("score"))
