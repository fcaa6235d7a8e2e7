"""License scans: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies.

A template of s distinct five-word shingles is looked for in windows of 2 s shingles, one every s: any stretch as long as
the template lies whole inside one of them. Where a window holds 80 % of a template, their Jaccard similarity is at least
0.8 s / (2 s + 0.2 s) = 0.36; with ``bands`` bands of one MinHash each, the odds of no collision are (1 - 0.36) ** 32, under
1e-6. Each (size, band, value) of a window is joined with those of the templates; a pair that meets in several bands counts
in the first. Templates that collide are verified by exact containment.

A few marking words (``marks``) occur in so many shingles of each template that no window without any of them contains 80 %
of it: only windows around such words are signed. That test is exact and makes no candidate by itself. Templates are
a fixed small list (``most_templates`` is checked), so the words and what is broadcast have a proven bound. All is built-in
expressions; only (document, template) counts are shuffled.

Defined cases: null and short texts match nothing; repeated rows of one doc_id give one row per template (counts add up);
a null doc_id is reported as null; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, ascii_lower, let, text_or_empty

#: Notices of common public licences, and passages of the texts of short ones; five words at least.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-header", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("mit", "Released under the MIT License."),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit-disclaimer", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY'),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-2.0-notice", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl-disclaimer", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("lgpl-2.1-notice", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("lgpl-3.0-notice", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("agpl-3.0-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc-4.0-notice", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-disclaimer", 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.'),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the Software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
)


@dataclass(frozen=True)
class Settings:
    shingle_words: int = 5
    percent: int = 80
    bands: int = 32
    most_templates: int = 400


def template_shingles(text: str, words: int) -> list[str]:
    """Distinct shingles in order."""
    w = re.findall("[a-z0-9]+", text.translate(str.maketrans(ASCII_UPPER, ASCII_LOWER)))
    return list(dict.fromkeys(" ".join(w[i : i + words]) for i in range(len(w) - words + 1)))


#: Words of ordinary prose, which mark a shingle only if all its words are such.
COMMON = frozenset("a an and any are as at be by can either for has have if in is it its may not of on or other such that the their they this to under use was which will with work you your".split())


def marks(templates, s: Settings) -> list[str]:
    """Words that more than a fifth of each template's shingles hold (100 - percent of them), so that any window that contains the template has one: long and uncommon ones."""
    out: set[str] = set()
    for _, text in templates:
        shingles = template_shingles(text, s.shingle_words)
        spare = len(shingles) - -(-s.percent * len(shingles) // 100)
        for w in sorted({w for x in shingles for w in x.split()}, key=lambda w: (w in COMMON, -len(w), w)):
            if sum(bool(out & set(x.split())) for x in shingles) > spare:
                break
            out.add(w)
    return sorted(out)


def hashed(w: Column, words: int) -> Column:
    """64-bit hashes of all shingles of an array of words, in order."""
    last = F.greatest(F.size(w) - words + 1, F.lit(0))
    return F.transform(F.slice(w, 1, last), lambda x, i: F.xxhash64(F.concat_ws(" ", x, *(F.get(w, i + k) for k in range(1, words)))))


def seeds(bands: int) -> list[int]:
    """One number for each band, spread over all 64-bit numbers."""
    step = (1 << 64) // bands
    return [(b * step + 0x9E3779B97F4A7C15 * (b + 1) % step) - (1 << 63) for b in range(bands)]


def minhashes(window: Column, bands: int) -> Column:
    """Of each band the hash that comes first in the order of h xor seed: hashes are random, so each of a set is as likely to."""
    return F.transform(F.array(*map(F.lit, seeds(bands))), lambda seed: F.array_min(F.transform(window, lambda h: h.bitwiseXOR(seed))).bitwiseXOR(seed))


def scan(docs: DataFrame, templates=TEMPLATES, s: Settings = Settings()) -> DataFrame:
    """(doc_id, license, n_windows, percent): windows that contain a template, and the best containment in whole per cent."""
    if len(templates) > s.most_templates:
        raise ValueError(f"more than {s.most_templates} templates")
    k, spark = s.shingle_words, docs.sparkSession
    listed = {name: template_shingles(text, k) for name, text in templates}
    rows = [(name, shingles) for name, shingles in listed.items() if shingles]
    known = spark.createDataFrame(rows, "license string, words array<string>").select("license", F.transform("words", lambda x: F.xxhash64(x)).alias("t"))
    known = known.select("license", "t", F.size("t").alias("size"), minhashes(F.col("t"), s.bands).alias("tm"))
    signed = F.broadcast(known.select("license", "t", "size", "tm", F.posexplode("tm").alias("band", "value")))
    marking = marks(templates, s)
    # texts without a marking word are passed over before they are cut into words
    some = docs.select("doc_id", text_or_empty().alias("text")).where(F.col("text").rlike(f"(?i)(?<![a-z0-9])(?:{'|'.join(marking)})(?![a-z0-9])") if marking else F.lit(False))
    worded = some.select("doc_id", F.filter(F.split(ascii_lower(F.col("text")), "[^a-z0-9]+"), lambda x: x != "").alias("w")).where(F.size("w") >= k)
    at = F.filter(F.transform("w", lambda x, i: F.when(x.isin(*marking), i)), lambda i: i.isNotNull())
    marked = worded.select("doc_id", "w", at.alias("at")).where(F.size("at") > 0)

    def windows(size: int) -> Column:
        """The windows of 2 * size shingles, one every size, that hold a marking word: their words."""
        last = F.floor((F.size("w") - k) / size).cast("int")
        first = lambda p: F.greatest(F.lit(0), F.ceil((p - 2 * size - k + 2) / size).cast("int"))
        of_word = lambda p: F.sequence(F.least(first(p), last), F.least(F.floor(p / size).cast("int"), last))
        numbers = F.array_distinct(F.flatten(F.transform("at", of_word)))
        return F.transform(numbers, lambda j: F.struct(F.lit(size).alias("size"), F.slice("w", j * size + 1, F.lit(2 * size + k - 1)).alias("w")))

    sizes = sorted({len(x) for _, x in rows})
    none = F.array().cast("array<struct<size:int,w:array<string>>>")
    cut = marked.select("doc_id", F.explode(F.concat(none, *(windows(n) for n in sizes))).alias("x"))
    both = let(F.array_distinct(hashed(F.col("x.w"), k)), lambda h: F.struct(h.alias("h"), minhashes(h, s.bands).alias("m")))
    cut = cut.select("doc_id", F.col("x.size").alias("size"), both.alias("y")).select("doc_id", "size", "y.h", "y.m")
    met = cut.select("doc_id", "size", "h", "m", F.posexplode("m").alias("band", "value")).join(signed, ["size", "band", "value"])
    first = F.array_position(F.zip_with("m", "tm", lambda a, b: a == b), True) - 1
    shared = F.size(F.array_intersect("h", "t"))
    verified = met.where(first == F.col("band")).select("doc_id", "license", "size", shared.alias("shared")).where(100 * F.col("shared") >= s.percent * F.col("size"))
    return verified.groupBy("doc_id", "license").agg(F.count("*").alias("n_windows"), F.max(F.floor(100 * F.col("shared") / F.col("size")).cast("long")).alias("percent"))


def oracle(templates=TEMPLATES, s: Settings = Settings()) -> str:
    """DuckDB SQL of scan() without any MinHash: every window against every template."""
    rows = ", ".join(f"('{n}', {len(ts)}, '{x}')" for n, t in templates if (ts := template_shingles(t, s.shingle_words)) for x in ts)
    grams = " || ' ' || ".join(f"w[i + {k}]" for k in range(s.shingle_words))
    return f"""
with t(license, size, g) as (values {rows}),
d as (select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[a-z0-9]+') as w from documents),
p as (select doc_id, r, w, unnest(range(1, len(w) - {s.shingle_words - 2})) as i from d where len(w) >= {s.shingle_words}),
g as (select doc_id, r, i - 1 as i, {grams} as g from p),
hit as (select distinct g.doc_id, g.r, t.license, t.size, t.g, unnest([g.i // t.size, g.i // t.size - 1]) as j from g join t on t.g = g.g),
c as (select doc_id, r, license, size, j, count(*) as n from hit where j >= 0 group by all)
select doc_id, license, cast(count(*) as bigint) as n_windows, cast(max(floor(100 * n / size)) as bigint) as percent
from c where 100 * n >= {s.percent} * size group by doc_id, license
"""
