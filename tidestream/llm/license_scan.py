"""Search for license notices in documents; built-in functions only.

Words are the runs of a-z and 0-9 of the lower-cased text. A notice is the set of hashes of its
five-word shingles, and it is in a document if at least 0.8 of them lie in one window of the
document. A notice of fewer words is one shingle, its whole word sequence, and is compared with
the document's runs of that length in the same way. For a notice of m shingles the windows hold m + s - 1 shingles and begin every
s = max(1, m div 4), so any occurrence lies whole in some window. A window and a notice it holds
then have a Jaccard similarity of at least 0.8 m / (m + s - 1 + 0.2 m), from which the number of
MinHash bands follows: at least one band of the two agrees with a probability of 0.9999. Windows
that agree with a notice in a band are compared exactly.

Windows without any shingle of a notice can't hold one and get no signature; that test is exact.
The notices are a short list given by the caller, and they travel in the plan as literals.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestream.session import stored

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
COLLISION_PROBABILITY = 0.9999

# Short notices by which works name their license.
NOTICES = {
    "mit": "Released under the MIT License.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "bsd": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
}

# Standard headers and characteristic passages of license texts. The GNU passages
# are short enough that another version or another license of the family stays below 0.8.
LICENSE_TEXTS = {
    "mit-conditions": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        'of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "bsd-3-clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."
    ),
    "bsd-disclaimer": (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "gpl-2.0-header": (
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"
    ),
    "gpl-3.0-header": (
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"
    ),
    "lgpl-2.0-header": (
        "under the terms of the GNU Library General Public License as published by the Free Software Foundation; "
        "either version 2 of the License"
    ),
    "lgpl-2.1-header": (
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License"
    ),
    "lgpl-3.0-header": (
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, "
        "either version 3 of the License"
    ),
    "agpl-3.0-header": (
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License"
    ),
    "gnu-text": (
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
    ),
    "apache-2.0-header": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "apache-2.0-text": (
        '"License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 '
        "through 9 of this document."
    ),
    "mpl-2.0-header": (
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "epl-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
    ),
    "cc-text": (
        "THE WORK (AS DEFINED BELOW) IS PROVIDED UNDER THE TERMS OF THIS CREATIVE COMMONS PUBLIC LICENSE. THE WORK IS "
        "PROTECTED BY COPYRIGHT AND/OR OTHER APPLICABLE LAW. ANY USE OF THE WORK OTHER THAN AS AUTHORIZED UNDER THIS "
        "LICENSE OR COPYRIGHT LAW IS PROHIBITED."
    ),
    "cc-4.0-text": (
        "To the extent this Public License may be interpreted as a contract, You are granted the Licensed Rights in "
        "consideration of Your acceptance of these terms and conditions, and the Licensor grants You such rights in "
        "consideration of benefits the Licensor receives from making the Licensed Material available under these terms "
        "and conditions."
    ),
    "cc0-text": (
        "to the extent that he or she is an owner of Copyright and Related Rights in the Work, voluntarily elects to "
        "apply CC0 to the Work and publicly distribute the Work under its terms"
    ),
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

# A notice of fewer than five words.
SHORT_NOTICES = {"all-rights-reserved": "All rights reserved."}

# Searched for by default.
TEMPLATES = {**NOTICES, **SHORT_NOTICES, **LICENSE_TEXTS}


def _words() -> Column:
    return F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))


def _with_shingles(df: DataFrame, name: str, size: int) -> DataFrame:
    """Replace `text` by the hashes of its shingles of `size` words; rows of fewer words have none and go."""
    others = [c for c in df.columns if c != "text"]
    # The generator makes the words once per row; inlined, they would be made for every shingle.
    df = df.select(*others, F.explode(F.array(_words())).alias("words")).where(F.size("words") >= size)
    starts = F.sequence(F.lit(0), F.size("words") - size)
    shingle = F.transform(starts, lambda i: F.xxhash64(*[F.col("words")[i + k] for k in range(size)]))
    return df.select(*others, shingle.alias(name))


def _longs(values) -> Column:
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def _signature(shingles: Column, bands: Column) -> Column:
    """One value per band: the smallest shingle hash after flipping that band's bits."""
    masks = F.transform(F.sequence(F.lit(1), bands), lambda b: F.xxhash64(b))
    return F.transform(masks, lambda mask: F.array_min(F.transform(shingles, lambda h: h.bitwiseXOR(mask))))


def window_plan(m: int, containment: float = CONTAINMENT) -> tuple[int, int, int]:
    """For notices of m shingles: window length, step between windows, number of bands."""
    step = max(1, m // 4)
    length = m + step - 1
    least = containment * m / (length + (1 - containment) * m)
    return length, step, math.ceil(math.log(1 - COLLISION_PROBABILITY) / math.log(1 - least))


def _notice_table(texts: DataFrame, size: int) -> DataFrame:
    """Rows (license, m, notice): the shingle hashes of every notice with shingles of `size` words."""
    shingles = _with_shingles(texts.where(_shingle_size() == size), "shingles", size)
    shingles = shingles.select("license", F.array_sort(F.array_distinct("shingles")).alias("notice"))
    return shingles.select("license", F.size("notice").alias("m"), "notice")


def _shingle_size() -> Column:
    """How many words the shingles of a notice have: five, or all of a shorter one."""
    return F.least(F.size(_words()), F.lit(SHINGLE_WORDS))


def scan_licenses(docs: DataFrame, notices: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """Rows (doc_id, license, containment, first_word, last_word), one per document row and notice.

    `first_word` and `last_word` are the ends (from 0) of the best window, the earliest of
    equals. Documents without a notice have no row; null texts have none. A null doc_id stays
    null, and repeated rows each give their rows. A notice of fewer than five words must occur
    word for word; one without words can't be searched for. Notices of one, two, three and four
    words take a pass for each of these lengths, over the texts that have all words of one of them. Very long texts are searched whole,
    and an empty table gives no rows. Only `doc_id` and `text` are read.
    """
    notices = TEMPLATES if notices is None else notices
    texts = docs.sparkSession.createDataFrame(list(notices.items()), "license string, text string")
    words = [r.words for r in texts.select(_words().alias("words")).collect()]  # the caller's short list
    found = []
    for size in sorted({min(len(w), SHINGLE_WORDS) for w in words} - {0}):
        table = _notice_table(texts, size)
        found.append(_scan(docs if size == SHINGLE_WORDS else _with_all_words(docs, [w for w in words if len(w) == size]), table, size, containment))
    return reduce(DataFrame.union, found)


def _with_all_words(docs: DataFrame, notices: list[list[str]]) -> DataFrame:
    """The documents whose text has all words of one of the notices, in any order and also within other words."""
    text = F.lower("text")
    return docs.where(reduce(Column.__or__, [reduce(Column.__and__, [F.contains(text, F.lit(w)) for w in words]) for words in notices]))


def _scan(docs: DataFrame, table: DataFrame, size: int, containment: float) -> DataFrame:
    """The rows of `scan_licenses` for notices with shingles of `size` words."""
    known = table.collect()  # the caller's short list
    everything = _longs(sorted({s for r in known for s in r.notice}))
    hashed = _with_shingles(docs.select("doc_id", "text"), "shingles", size).where(F.arrays_overlap("shingles", everything))
    likely = stored(hashed.withColumn("row", F.monotonically_increasing_id()), "license-documents")

    plans = [(m, *window_plan(m, containment)) for m in sorted({r.m for r in known})]
    shapes = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(p, ("m", "length", "step", "bands"))]) for p in plans])
    windows = likely.select("row", "doc_id", "shingles", F.inline(shapes))
    windows = windows.withColumn("start", F.explode(F.sequence(F.lit(1), F.size("shingles"), F.col("step"))))
    windows = windows.select("row", "doc_id", "m", "length", "bands", "start", F.array_distinct(F.slice("shingles", F.col("start"), F.col("length"))).alias("window"))
    windows = stored(windows.where(F.arrays_overlap("window", everything)), "license-windows")

    bands = {m: n for m, _, _, n in plans}
    agreed = windows.select("row", "doc_id", "m", "length", "start", "window", F.posexplode(_signature(F.col("window"), F.col("bands"))).alias("band", "value"))
    band_count = F.element_at(F.create_map(*[F.lit(x) for pair in bands.items() for x in pair]), F.col("m"))
    of_notice = table.select("license", "m", "notice", F.posexplode(_signature(F.col("notice"), band_count)).alias("band", "value"))
    # One row per notice and band: as short as the caller's list.
    agreed = agreed.join(F.broadcast(of_notice), ["m", "band", "value"])
    share = F.size(F.array_intersect("window", "notice")) / F.col("m")
    hits = agreed.withColumn("containment", share).where(F.col("containment") >= containment)
    best = hits.groupBy("row", "doc_id", "license").agg(
        F.max(F.struct("containment", (-F.col("start")).alias("at"), "length")).alias("b")
    )
    first = -F.col("b.at") - 1
    return best.select(
        "doc_id",
        "license",
        F.col("b.containment").alias("containment"),
        first.cast("long").alias("first_word"),
        (first + F.col("b.length") + size - 2).cast("long").alias("last_word"),
    )
