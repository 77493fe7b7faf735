"""License scans by conditional compression.

The words around one that speaks of rights, in lower case, are compressed with zstandard,
once alone and once with each license wording as a raw dictionary. What a wording saves
ranks it. In this order wordings are placed where the fewest words are missing or added,
and these are told; the first that differs little enough is found. A wording with another
number or another qualifying word is another license, however close.

Texts are scanned where they lie; there is no shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_right, insort
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import map_texts
from shelfmark.operators.once import once_per_worker

# Common license notices and the operative wording of short licenses.
WORDINGS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions:",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:",
    ),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("LicenseRef-proprietary", "All rights reserved."),
    ("Apache-2.0", "Licensed under the Apache License 2.0."),
    ("Apache-2.0", "Apache License 2.0"),
    ("MIT", "under the terms of the MIT license"),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("GPL-3.0", "Licensed under the GPL v3.0."),
    ("GPL-3.0", "Licensed under GPL v3.0."),
    ("GPL-2.0", "Licensed under the GPL v2.0."),
    ("GPL-2.0", "Licensed under GPL v2.0."),
    ("CC-BY-SA-3.0", "Licensed under CC BY-SA 3.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
        'documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, '
        "and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so,",
    ),
]
# Identifiers of the list of licenses that a line of a source file may name.
IDENTIFIERS = (
    "Apache-2.0 MIT GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only "
    "LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later MPL-2.0 BSD-2-Clause BSD-3-Clause ISC BSL-1.0 CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 Unlicense"
).split()
WORDINGS += [(i, f"SPDX-License-Identifier: {i}") for i in IDENTIFIERS]

#: Words around one of these may belong to a license.
SIGNS = (b"licen", b"copyright", b"rights reserved", b"permission", b"redistribut", b"public domain", b"warrant", b"spdx", b"free software", b"cc by", b"cc0")
SIGN = re.compile("|".join(re.escape(s.decode()).replace(r"\ ", r"[\W_]+") for s in SIGNS), re.I)
FIRST_WORDS = tuple(s.decode().split()[0] for s in SIGNS)
WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
#: Words that tell licenses apart; a difference in one of them is never minor.
TELLING = frozenset("not no non nc nd sa by lesser affero later only attribution sharealike noncommercial noderivatives".split())


@dataclass(frozen=True)
class Finding:
    start: int  # code points of the text
    stop: int
    license: str
    gain: float  # share of its compressed size that the stretch loses
    differences: tuple[str, ...]


def words(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def _compressors(wordings: tuple[tuple[str, str], ...]):
    """One compressor alone, and one for each wording."""
    level = 9
    # Sizes only: no checksum, size or dictionary id in the frame.
    plain = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
    make = lambda **more: zstandard.ZstdCompressor(level=level, **plain, **more)
    each = [make(dict_data=zstandard.ZstdCompressionDict(" ".join(words(t)).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for _, t in wordings]
    return make(), each


def signs(text: str) -> list[int]:
    """Where signs begin; between the words of a sign anything but words may stand, also
    the end of a line and a comment mark."""
    low = text.lower()
    if not any(s in low for s in FIRST_WORDS):
        return []
    return [m.start() for m in SIGN.finditer(text)]


def differences(wording: list[str], block: list[str]) -> tuple[int, int, list[str]]:
    """Where the wording stands among the block's words, and how they differ: the place
    with the fewest words missing or added."""
    ids = {w: i for i, w in enumerate(wording)}
    own = np.array([ids[w] for w in wording])
    said = np.fromiter((ids.get(w, -1) for w in block), np.int64, len(block))
    steps = np.arange(len(block) + 1)
    cost = np.zeros((len(own) + 1, len(block) + 1), np.int64)  # row 0: before the wording nothing is a difference
    for i, w in enumerate(own, 1):
        row = cost[i - 1] + 1
        row[1:] = np.where(said == w, np.minimum(row[1:], cost[i - 1][:-1]), row[1:])
        cost[i] = np.minimum.accumulate(row - steps) + steps
    i, j = len(own), int(np.argmin(cost[-1]))
    stop, told = j, []
    while i:
        if j and said[j - 1] == own[i - 1] and cost[i, j] == cost[i - 1, j - 1]:
            i, j = i - 1, j - 1
            told.append("")
        elif cost[i, j] == cost[i - 1, j] + 1:
            i -= 1
            told.append(f"-{wording[i]}")
        else:
            j -= 1
            told.append(f"+{block[j]}")
    if "" not in told:
        return 0, 0, [f"-{w}" for w in wording]
    told.reverse()
    # In place of words missing at an end stand as many others.
    first, last = told.index(""), told[::-1].index("")
    start, end = max(0, j - first), min(len(block), stop + last)
    told = told[:first] + [f"+{w}" for w in block[start:j]] + told[first:] + [f"+{w}" for w in block[stop:end]]
    out = []
    for same, run in groupby(told, lambda x: x == ""):
        if not same:
            out += sorted(run, key=lambda x: x[0] == "+")
    return start, end, out


def minor(changed: list[str], size: int, share: float) -> bool:
    """Few words differ, and none with a number or one that tells licenses apart."""
    if len(changed) > share * size:
        return False
    return not any(any(ch.isdigit() for ch in w) or TELLING & set(re.split(r"[+.-]", w)) for w in changed)


def ranked(block: bytes, alone: zstandard.ZstdCompressor, each: list[zstandard.ZstdCompressor]) -> list[int]:
    """The wordings whose dictionary makes the block smaller, by how much; of equal ones the
    first."""
    size = len(alone.compress(block))
    saved = [size - len(c.compress(block)) for c in each]
    return sorted((i for i, n in enumerate(saved) if n > 0), key=lambda i: -saved[i])


def scan(text: str, wordings=tuple(WORDINGS), least_gain: float = 0.25, share: float = 0.1) -> list[Finding]:
    """License wordings of a text, in order.

    Around each sign the longest wording's number of words on both sides is a block,
    however the lines are broken. Wordings are ranked by the bytes that they save as its
    dictionary, and the first that its words confirm is found; what differs must gain
    ``least_gain`` from the wording, too. It is cut out and the rest judged again, so that
    several may stand side by side. All that save anything are gone through.
    """
    places = [m.span() for m in WORD.finditer(text)] if (at := signs(text)) else []
    if not places:
        return []
    alone, each = once_per_worker("wordings", wordings, lambda: _compressors(wordings))
    spoken = [text[a:b].lower() for a, b in places]
    starts = [a for a, _ in places]
    own = [words(t) for _, t in wordings]
    reach = max(int(len(w) * (1 + share)) + 1 for w in own)
    found: list[tuple[int, int, Finding]] = []  # in order of their words
    for sign in sorted({bisect_right(starts, k) - 1 for k in at}):
        k = bisect_right(found, sign, key=lambda f: f[0])
        low = max(0, sign - reach, found[k - 1][1] if k else 0)
        high = min(len(spoken), sign + reach + 1, found[k][0] if k < len(found) else len(spoken))
        while low <= sign < high:
            piece = spoken[low:high]
            confirmed = None
            for i in ranked(" ".join(piece).encode(), alone, each):
                a, b, changed = differences(own[i], piece)
                if b <= a or not minor(changed, len(own[i]), share):
                    continue
                raw = " ".join(piece[a:b]).encode()
                gain = 1 - len(each[i].compress(raw)) / len(alone.compress(raw))
                if not changed or gain >= least_gain:
                    confirmed = a + low, b + low, wordings[i][0], changed, gain
                    break
            if not confirmed:
                break
            a, b, name, changed, gain = confirmed
            insort(found, (a, b, Finding(starts[a], places[b - 1][1], name, gain, tuple(changed))), key=lambda f: f[0])
            low, high = (b, high) if b <= sign else (low, a)
    return [f for _, _, f in found]


FINDING = pa.struct(
    [("license", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("gain", pa.float64()), ("differences", pa.list_(pa.string()))]
)


def with_licenses(
    docs: DataFrame, wordings: list[tuple[str, str]] | None = None, text: str = "text", out: str = "licenses", keep: list[str] | None = None
) -> DataFrame:
    """Add the license wordings of a text, in order of place: license, start and stop (code
    points), gain and the words that differ (``-`` missing, ``+`` added).

    A null or empty text has none. A wording that stands twice is found twice; of
    wordings that fit one place the one that explains most bytes of what stands around it
    is taken. An input column named like the output is replaced.
    """
    known = tuple(wordings or WORDINGS)
    kind = "array<struct<license:string,start:bigint,stop:bigint,gain:double,differences:array<string>>>"

    def step(texts):
        rows = [
            [
                {"license": f.license, "start": f.start, "stop": f.stop, "gain": f.gain, "differences": list(f.differences)}
                for f in scan(t.as_py().decode("utf-8", "replace"), known)
            ]
            for t in texts
        ]
        return [rows]

    return map_texts(docs, lambda: step, [(out, kind, pa.list_(FINDING))], text, keep)


def digest(docs: DataFrame) -> DataFrame:
    found = with_licenses(docs, keep=["doc_id"])
    return found.select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda f: f.license))), ",").alias("licenses"),
        F.size("licenses").cast("bigint").alias("n_found"),
        F.size(F.filter("licenses", lambda f: F.size(f.differences) == 0)).cast("bigint").alias("n_exact"),
        F.col("licenses").alias("findings"),
    )
