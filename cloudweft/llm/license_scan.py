"""Licence scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them.

Words are runs of ASCII letters and digits, lower-cased, and of bytes beyond ASCII. For a template of L words, windows
of L + L // 2 words begin every max(1, L // 2) words, so that any L words in a row lie in one window. A window that holds
``CONTAINMENT`` of a template's shingles has a Jaccard similarity with it of at least ``least_similarity``; the rows of a
band are the most for which ``BANDS`` bands miss such a window with a probability of at most ``MISS``. A minimum that a
window shares with a template is the hash of a shingle that both hold, so bands can retrieve nothing for a window without
a shingle of some template: such windows are left out before their bands are computed, which changes no result. A retrieved template matches where the window's shingles contain at least ``CONTAINMENT`` of its own.

Defined results: null, empty and short texts have no licence; repeated rows get equal results; an empty table gives an
empty result; other columns are kept as they are, a column ``matches``, in whatever case, is replaced; long texts are taken whole. Matches of one template that overlap are one span.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from cloudweft.llm.common import arrow_mapped, others

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 64
MISS = 1e-6

#: Notices of public licences, by SPDX name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

_TO_WORDS = bytes(c if c >= 128 or chr(c).isalnum() and not 65 <= c <= 90 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_SEEDS = np.array([xxhash.xxh3_64_intdigest(b"licence", seed=k) for k in range(BANDS * 8)], dtype=np.uint64)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO_WORDS).split()


def shingles(own: list[bytes]) -> list[tuple[bytes, ...]]:
    return [tuple(own[k : k + SHINGLE]) for k in range(len(own) - SHINGLE + 1)]


def least_similarity(length: int, containment: float = CONTAINMENT) -> float:
    """Of a window that holds ``containment`` of the shingles of a template of ``length`` words."""
    own, window = length - SHINGLE + 1, length + length // 2 - SHINGLE + 1
    both = math.ceil(containment * own)
    return both / (own + window - both)


def rows_of(similarity: float) -> int:
    """The most rows of a band (8 at most) for which BANDS bands miss with a probability of at most MISS."""
    return max(r for r in range(1, 9) if r == 1 or (1 - similarity**r) ** BANDS <= MISS)


def minima(hashes: np.ndarray, rows: int) -> list[int]:
    """BANDS keys of a set of shingle hashes, each of ``rows`` minima under different permutations."""
    x = hashes[None, :] ^ _SEEDS[: BANDS * rows, None]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    least = x.min(axis=1).reshape(BANDS, rows)
    return [xxhash.xxh3_64_intdigest(row.tobytes(), seed=k) for k, row in enumerate(least)]


def hashed(own: set[tuple[bytes, ...]]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(b" ".join(s)) for s in own], dtype=np.uint64)


@dataclass(frozen=True)
class Template:
    name: str
    length: int
    rows: int
    shingles: frozenset[tuple[bytes, ...]]


class Index:
    """Templates by band key, for each length; bounded by the templates given."""

    def __init__(self, texts: dict[str, str], containment: float = CONTAINMENT) -> None:
        self.containment = containment
        self.vocabulary: set[bytes] = set()
        self.members: set[tuple[bytes, ...]] = set()
        self.lengths: dict[tuple[int, int], dict[int, list[Template]]] = {}
        for name, text in sorted(texts.items()):
            own = words(text)
            if len(own) < SHINGLE:
                raise ValueError(f"template {name} has fewer than {SHINGLE} words")
            template = Template(name, len(own), rows_of(least_similarity(len(own), containment)), frozenset(shingles(own)))
            self.vocabulary.update(own)
            self.members.update(template.shingles)
            table = self.lengths.setdefault((template.length, template.rows), defaultdict(list))
            for key in minima(hashed(set(template.shingles)), template.rows):
                table[key].append(template)

    def scan(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(name, first word, end of words, containment) of all matches, by place."""
        own = words(text)
        if len(own) < SHINGLE:
            return []
        inside = np.fromiter(map(self.vocabulary.__contains__, own), np.bool_, len(own))
        runs = np.convolve(inside, np.ones(SHINGLE, dtype=np.int64), "valid") == SHINGLE
        hits = np.array([k for k in np.flatnonzero(runs) if tuple(own[k : k + SHINGLE]) in self.members], dtype=np.int64)
        if not len(hits):
            return []
        found: dict[str, list[tuple[int, int, float]]] = defaultdict(list)
        for (length, rows), table in self.lengths.items():
            size, stride = length + length // 2, max(1, length // 2)
            last = max(0, -(-(len(own) - size) // stride))
            low = np.maximum(0, -(-(hits + SHINGLE - size) // stride))
            starts = sorted({k for a, b in zip(low, np.minimum(hits // stride, last), strict=True) for k in range(a, b + 1)})
            for start in (k * stride for k in starts):
                window = shingles(own[start : start + size])
                some = set(window)
                if some.isdisjoint(self.members):
                    continue
                for template in {t.name: t for key in minima(hashed(some), rows) for t in table.get(key, ())}.values():
                    share = len(some & template.shingles) / len(template.shingles)
                    if share >= self.containment:
                        at = [k for k, s in enumerate(window) if s in template.shingles]
                        found[template.name].append((start + at[0], start + at[-1] + SHINGLE, share))
        return sorted(((name, *span) for name, spans in found.items() for span in merged(spans)), key=lambda x: (x[1], x[2], x[0]))


def merged(spans: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    out: list[tuple[int, int, float]] = []
    for start, end, share in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]), max(share, out[-1][2]))
        else:
            out.append((start, end, share))
    return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, then matches: an array of (license, start, end, containment), in words."""
    texts = dict(templates or TEMPLATES)
    kept = others(docs, text_col, "matches")
    match = StructType([StructField("license", StringType()), StructField("start", LongType()), StructField("end", LongType()), StructField("containment", DoubleType())])
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())]))

    def compute(parts: Iterable[pa.Array]) -> Iterator[list[pa.Array]]:
        index = Index(texts, containment)
        for part in parts:
            found = [[dict(zip(("license", "start", "end", "containment"), m, strict=True)) for m in index.scan(text)] for text in part.to_pylist()]
            yield [pa.array(found, kind)]

    return arrow_mapped(docs, text_col, kept, compute, ("matches", ArrayType(match)))
