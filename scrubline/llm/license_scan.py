"""Licence scan: sparse TF-IDF cosine to templates, then inheritance by directory.

Lines, paragraphs and sentences that hold a licence word are the candidates (whole
texts are searched; headers, footers and licence files alike), and around every licence
word of a longer one the words that a notice of a template's length would take
(``WINDOWS``): a notice is found wherever it stands. Their term weights are
compared with the templates by sparse joins on the term; the template side is a
fixed small table and is broadcast. The cosine is taken over the templates'
vocabulary: names, years and other words beside a notice have no weight, so that a
notice scores alike in a small and a large corpus. Names, versions and modifiers
(``_DECIDING``) must agree, whatever the cosine. Document frequencies are counted
over all candidates of the corpus.

A text may have several licences: the best notice of every family (the GNU
licences are one, the Creative Commons ones another, the BSD ones a third) and what
an SPDX line names, whose expression is kept as it stands.

A licence file (LICENSE, COPYING, ...) whose own text is recognised gives its
licences to its directory. A file without a recognised licence takes that of the
nearest ancestor directory: the distinct directories are joined with the
licensed ones on their ancestor paths, and files look up their directory.

DataFrame expressions only. Null or empty texts have no licence of their own; a
null path is the root and inherits nothing; repeated rows are scanned each. Ties
go to the higher cosine, then the alphabetically first licence. Extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stage

THRESHOLD = 0.6

_MODIFIERS = {"NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
#: Notices by licence (fixed values).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed: MIT License"),
    ("MIT", "Licensed under the MIT license. See LICENSE file in the project root."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files, to deal in the Software without "
            "restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use "
                   "this file except in compliance with the License."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found "
                     "in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
            "or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the Software), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, "
            "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use "
                   "this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors "
                     "may be used to endorse or promote products derived from this software "
                     "without specific prior written permission."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. "
                "2.0. If a copy of the MPL was not distributed with this file, You can obtain one "
                "at https://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
            "or without fee is hereby granted, provided that the above copyright notice and this "
            "permission notice appear in all copies."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and "
                "related and neighboring rights to this work to the public domain worldwide under "
                "CC0 1.0."),
    ("CC0-1.0", "Released under the CC0 1.0 Universal Public Domain Dedication."),
    ("CC0-1.0", "This work is licensed under a Creative Commons Zero 1.0 Universal License."),
    *(("EPL-2.0", t) for t in (
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License v. 2.0",
        "Licensed under the Eclipse Public License, version 2.0.")),
    *(("EPL-1.0", t) for t in (
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License v. 1.0",
        "Licensed under the Eclipse Public License, version 1.0.")),
    ("EUPL-1.2", "Licensed under the European Union Public Licence (EUPL), version 1.2."),
    ("EUPL-1.2", "Licensed under the EUPL, Version 1.2 or as soon they will be approved by the "
                 "European Commission subsequent versions of the EUPL"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("Artistic-2.0", "Licensed under the Artistic License 2.0."),
    ("Artistic-2.0", "This program is free software; you can redistribute it and/or modify it under "
                     "the terms of the Artistic License (2.0)."),
    ("Proprietary", "All rights reserved. Confidential and proprietary; do not distribute."),
    *((f"{gnu}-{v}", text.format(name=name, version=f"version {v.removesuffix('.0')}"))
      for gnu, name, versions in (("GPL", "", ("2.0", "3.0")), ("LGPL", "Lesser ", ("2.1", "3.0")),
                                  ("AGPL", "Affero ", ("3.0",)))
      for v in versions for text in (
          "This work is licensed under the GNU {name}General Public License, {version}.",
          "This program is free software: you can redistribute it and/or modify it under the terms "
          "of the GNU {name}General Public License as published by the Free Software Foundation, "
          "either {version} of the License, or (at your option) any later version.",
          "This library is free software; you can redistribute it and/or modify it under the terms "
          "of the GNU {name}General Public License {version}")),
    *((f"CC-BY{''.join(f'-{m}' for m in mods)}-4.0", text.format(
        short="".join(f"-{m}" for m in mods), long="".join(f"-{_MODIFIERS[m]}" for m in mods)))
      for mods in ((), ("SA",), ("NC",), ("ND",), ("NC", "SA"), ("NC", "ND")) for text in (
          "This work is licensed under a Creative Commons Attribution{long} 4.0 International "
          "License.", "Licensed under CC BY{short} 4.0.")),
    *((name, f"SPDX-License-Identifier: {name}") for name in (
        "MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0",
        "BSD-2-Clause", "BSD-3-Clause", "ISC", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
        "CC-BY-NC-4.0", "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0", "EPL-2.0", "EPL-1.0",
        "EUPL-1.2", "BSL-1.0", "Artistic-2.0")),
)
#: Names, versions and modifiers: those of a template must all be in a notice, and
#: a notice's modifiers all in a template of that family.
_DECIDING = ("1", "1.2", "2", "2.1", "3", "4", "mit", "apache", "mozilla", "mpl", "isc", "bsd", "gnu", "gpl",
             "lgpl", "agpl", "lesser", "affero", "nc", "nd", "sa", "cc0", "zero", "unencumbered",
             "unlicense", "endorse", "obtaining", "fee", "redistribution", "confidential", "eclipse",
             "epl", "eupl", "boost", "bsl", "artistic")
#: Beginnings of the names of licences of which a text has one at most.
_ONE_OF = r"^[AL]?(GPL)|^(CC)|^(BSD)|^(EPL)"
#: Words before and after a licence word that make a candidate of a longer text.
WINDOWS = ((5, 6), (14, 20), (6, 64))
LONG_UNIT = 24
_SPDX = r"(?i)SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]+)"
_FAMILIES = {"gnu": (("gnu", "gpl", "lgpl", "agpl"), ("lesser", "affero", "lgpl", "agpl")),
             "cc": (("cc", "commons", "cc0"), ("nc", "nd", "sa", "cc0", "zero"))}
#: One spelling of versions and modifiers.
_SPELLINGS = ((r"(?<![a-z0-9])([la]?gpl|mpl)(?=v?[0-9])", "$1 "), (r"(?<![a-z0-9])v\.? ?(?=[0-9])", " "),
              (r"(?<=[0-9])(?:\.0)+(?!\.?[0-9])", ""), (r"share[ -]?alike", "sa"),
              (r"non[ -]?commercial", "nc"), (r"no[ -]?derivatives?|no[ -]?derivs?", "nd"))
_CUE = (r"(?i)licen[sc]e|copyright|spdx|redistribut|permission (?:is|to)|public domain|"
        r"all rights reserved|creative commons|\bCC[ -]BY|\bCC0\b|endorse or promote")
#: What a lower-cased text must hold to have such a line at all (plain substrings:
#: much faster than the pattern on texts that have none).
_HINTS = ("licen", "copyright", "spdx", "redistribut", "permission ", "public domain",
          "rights reserved", "creative commons", "cc by", "cc-by", "cc0", "endorse or promote")
_LICENSE_FILE = r"(?i)^(?:un)?licen[sc]e|^copying|^copyright|^notice"
_TERM = r"[a-z][a-z0-9]*|[0-9]+(?:\.[0-9]+)*"


def _may_hold_notice(text: Column) -> Column:
    return let(F.lower(text), lambda t: F.exists(
        F.array(*[F.lit(h) for h in _HINTS]), lambda h: F.contains(t, h)))


def _terms(text: Column) -> Column:
    out = F.lower(text)
    for pattern, to in _SPELLINGS:
        out = F.regexp_replace(out, pattern, to)
    return F.regexp_extract_all(out, F.lit(_TERM), F.lit(0))


def _around(unit: Column) -> Column:
    """The words around every licence word of a unit; none for a short one."""
    def cut(words: Column) -> Column:
        at = F.filter(F.transform(words, lambda w, i: F.when(
            # A licence word, or its first one where it is made of two.
            F.concat_ws(" ", w, F.get(words, i + 1)).rlike(_CUE), i)), lambda i: i.isNotNull())
        pieces = F.transform(at, lambda i: F.array(*[F.concat_ws(" ", F.slice(
            words, F.greatest(F.lit(1), i + 1 - before), i + 1 + after
            - F.greatest(F.lit(1), i + 1 - before) + 1)) for before, after in WINDOWS]))
        return F.when(F.size(words) > LONG_UNIT, F.flatten(pieces)).otherwise(
            F.array().cast("array<string>"))

    return let(F.split(F.trim(unit), r"\s+"), cut)


def _candidates(docs: DataFrame) -> DataFrame:
    """(rid, unit, term, tf) of the lines, paragraphs, sentences and windows with a
    licence word."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(_CUE))
    paragraphs = F.filter(F.split("text", r"\n[ \t\r]*\n"), lambda x: x.rlike(_CUE))

    def more(units: Column) -> Column:
        sentences = F.filter(F.flatten(F.transform(units, lambda u: F.split(
            u, r"(?<=[.;!?])\s+"))), lambda x: x.rlike(_CUE))
        # What one sentence offers to choose from.
        choices = F.filter(F.flatten(F.transform(sentences, lambda u: F.split(
            u, r"(?i)\s+(?:and/or|or|and)\s+"))), lambda x: x.rlike(_CUE))
        windows = F.filter(F.flatten(F.transform(sentences, _around)), lambda x: x.rlike(_CUE))
        return F.array_distinct(F.concat(units, sentences, choices, windows))

    units = let(F.array_distinct(F.concat(lines, paragraphs)), more)
    unit = docs.filter(F.col("text").isNotNull()).select("rid", F.posexplode(units).alias(
        "unit", "words"))
    term = unit.select("rid", "unit", F.explode(_terms(F.col("words"))).alias("term"))
    return term.groupBy("rid", "unit", "term").agg(F.count(F.lit(1)).alias("tf"))


def spdx_names(text: Column) -> Column:
    """The licence names of a text's SPDX lines, and nothing else that stands there."""
    known = F.array(*[F.lit(n) for n in sorted({n for n, _ in TEMPLATES})])
    named = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(_SPDX), F.lit(1)), lambda x: F.split(
        F.regexp_replace(F.trim(x), r"[()]", " "), r"\s+")))
    plain = F.transform(named, lambda n: F.regexp_replace(n, r"(?<=[0-9])(?:\+|-only|-or-later)$", ""))
    return F.array_intersect(known, plain)


def spdx_expression(text: Column) -> Column:
    """The first SPDX expression of a text (such as ``MIT OR Apache-2.0``), or null."""
    found = F.trim(F.regexp_replace(F.regexp_extract(text, _SPDX, 1), r"\s+", " "))
    return F.when(found != "", found)


def _template_terms(spark) -> DataFrame:
    t = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(TEMPLATES)],
                              "tid int, license string, text string")
    return (t.select("tid", "license", F.explode(_terms(F.col("text"))).alias("term"))
            .groupBy("tid", "license", "term").agg(F.count(F.lit(1)).alias("ttf")))


def own_licenses(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(rid, license, score, licenses) of the rows with a recognised notice: the best
    one, and all of them by name."""
    spark = docs.sparkSession
    cand = stage(_candidates(docs), "license_terms")
    templates = _template_terms(spark)
    n = F.lit(float(cand.select("rid", "unit").distinct().count()))
    vocabulary = templates.select("term").distinct()
    df = (cand.join(F.broadcast(vocabulary), "term").groupBy("term")
          .agg(F.count(F.lit(1)).alias("df")))
    idf = lambda d: F.log((n + 1.0) / (d + 1.0)) + 1.0
    weights = vocabulary.join(df, "term", "left").select(
        "term", idf(F.coalesce(F.col("df"), F.lit(0))).alias("idf"))
    # At most one row per term of the templates: a fixed, small table.
    t = templates.join(weights, "term").withColumn("tw", F.col("ttf") * F.col("idf"))
    among = lambda terms: F.sum(F.col("term").isin(*terms).cast("int"))
    own = ["tn", "td", *(f"t_{f}" for f in _FAMILIES)]
    norms = t.groupBy("tid").agg(
        F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tn"), among(_DECIDING).alias("td"),
        *((among(of) > 0).alias(f"t_{f}") for f, (of, _) in _FAMILIES.items()))
    t = t.join(norms, "tid").select("tid", "license", "term", "tw", *own)
    w = cand.join(F.broadcast(weights), "term").select(
        "rid", "unit", "term", (F.col("tf") * F.col("idf")).alias("w"))
    length = w.groupBy("rid", "unit").agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("un"),
        *(among(mods).alias(f"u_{f}") for f, (_, mods) in _FAMILIES.items()))
    dot = (w.join(F.broadcast(t), "term").groupBy("rid", "unit", "tid", "license", *own)
           .agg(F.sum(F.col("w") * F.col("tw")).alias("dot"), among(_DECIDING).alias("d"),
                *(among(mods).alias(f"d_{f}") for f, (_, mods) in _FAMILIES.items())))
    cos = dot.filter("d = td").join(length, ["rid", "unit"])
    for f in _FAMILIES:
        cos = cos.filter(~F.col(f"t_{f}") | (F.col(f"u_{f}") == F.col(f"d_{f}")))
    cos = cos.withColumn(
        "score", F.round(F.col("dot") / (F.col("un") * F.col("tn")), 6)).filter(
        F.col("score") >= threshold)
    # One licence per family: near licences share most of a notice.
    cos = cos.withColumn("family", F.coalesce(F.nullif(F.concat(*[
        F.regexp_extract("license", _ONE_OF, g) for g in range(1, 5)]), F.lit("")), F.col("license")))
    best = cos.groupBy("rid", "family").agg(
        F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b"),
        F.max(F.col("license") == "BSD-3-Clause").alias("third"))
    # The two BSD licences begin alike: the third clause decides.
    name = F.when(F.col("third") & (F.col("b.license") == "BSD-2-Clause"),
                  "BSD-3-Clause").otherwise(F.col("b.license"))
    return best.groupBy("rid").agg(
        F.min(F.struct(F.col("b.s").alias("s"), name.alias("license"))).alias("b"),
        F.sort_array(F.collect_set(name)).alias("licenses")).select(
        "rid", "b.license", (-F.col("b.s")).alias("score"), "licenses")


def scan(df: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text",
         threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, path, license (the best notice's), score, origin
    (own, inherited or none), license_dir (of the licence file that it comes from),
    licenses (all of them) and expression (of an SPDX line)."""
    path = F.coalesce(F.col(path_col), F.lit(""))
    src = df.select(F.col(id_col).alias("doc_id"), F.col(path_col).alias("path"),
                    F.regexp_extract(path, r"^(.*)/[^/]*$", 1).alias("dir"),
                    F.regexp_extract(path, r"([^/]*)$", 1).alias("name"),
                    F.col(text_col).alias("text"))
    # A row number of its own per input row, so that repeated ids stay apart; it is
    # fixed by staging the paths. Only rows with a licence word keep their text.
    src = stage(src.withColumn("text", F.when(_may_hold_notice(F.col("text")), F.col("text")))
                .withColumn("rid", F.monotonically_increasing_id()), "license_rows")
    own = stage(own_licenses(src.select("rid", "text"), threshold), "license_own")
    rows = src.select("rid", "doc_id", "path", "dir", "name",
                      spdx_names(F.coalesce("text", F.lit(""))).alias("named"),
                      spdx_expression(F.coalesce("text", F.lit(""))).alias("expression")).join(
        own, "rid", "left")
    # An SPDX line names its licences itself.
    rows = rows.withColumn("license", F.when(
        (F.size("named") > 0) & ~F.coalesce(F.array_contains("named", F.col("license")), F.lit(False)),
        F.get("named", F.lit(0))).otherwise(F.col("license"))).withColumn(
        "licenses", F.when(F.size("named") > 0, F.col("named")).otherwise(F.col("licenses")))
    licensed = (rows.filter(F.col("license").isNotNull() & F.col("name").rlike(_LICENSE_FILE))
                .groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "license",
                                                   "licenses")).alias("b"))
                .select(F.col("dir").alias("license_dir"), F.col("b.license").alias("dir_license"),
                        F.col("b.licenses").alias("dir_licenses")))
    dirs = src.filter(F.col("path").isNotNull()).select("dir").distinct()
    parts = F.split("dir", "/")
    above = dirs.select("dir", F.explode(F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(
        F.concat(F.array(F.lit("")), F.transform(
            F.sequence(F.lit(1), F.size(parts)),
            lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))))).alias("license_dir"))
    nearest = (above.join(licensed, "license_dir").groupBy("dir")
               .agg(F.max(F.struct(F.length("license_dir").alias("depth"), "license_dir",
                                   "dir_license", "dir_licenses")).alias("n"))
               .select("dir", "n.license_dir", "n.dir_license", "n.dir_licenses"))
    out = rows.join(nearest, "dir", "left")
    mine = F.col("license").isNotNull()
    usable = F.col("path").isNotNull() & F.col("dir_license").isNotNull()
    return out.select(
        "doc_id", "path",
        F.when(mine, F.col("license")).when(usable, F.col("dir_license")).alias("license"),
        "score",
        F.when(mine, "own").when(usable, "inherited").otherwise("none").alias("origin"),
        F.when(~mine & usable, F.col("license_dir")).alias("license_dir"),
        F.when(mine, F.col("licenses")).when(usable, F.col("dir_licenses")).otherwise(
            F.array().cast("array<string>")).alias("licenses"),
        "expression")
