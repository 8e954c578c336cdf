"""License texts in documents: winnowed fingerprints, then banded alignment.

Words are those of letters and digits in lower case. Of every ``SPAN`` consecutive word
``GRAM``-grams of a template the one with the smallest hash is a fingerprint; the inverted
index has its templates and places. A template of at most ``SHORT`` words has all its grams
there, so short that a text with ``COVERAGE`` of its words has one of them unbroken. Every gram of a document probes the index. Hits of a
template whose diagonals (place in the document less place in the template) differ by at
most its band, an eighth of its words and ``BAND`` at most, and whose places are no further
apart than the template is long form a candidate, whose words are aligned with the template's inside that band: the longest common
subsequence there gives matched words and their span. Candidates with at least ``COVERAGE``
of the template matched are reported if their span has the phrases that tell the template
from its neighbours (``REQUIRED``: version and variant, as unbroken words); of reports that overlap, those with more matched words
stay, then the longer template, then its name.

Templates are a parameter of bounded size (``TEMPLATE_BYTES``); the index goes to all tasks.
Documents are neither shuffled nor cut. Defined results: null and empty texts have no
licenses; a template without words is never found; equal templates are both named.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm import words as W
from quotelake.llm.store import prepared

GRAM = 3
SPAN = 4
SHORT = 64
BAND = 8
COVERAGE = 0.8
TEMPLATE_BYTES = 16 << 20
FOUND = "array<struct<license:string,low:int,high:int,matched:int,coverage:double>>"

_GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} "
    "as published by the Free Software Foundation, either version {} of the License, or "
    "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
    "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
    "PURPOSE. See the GNU {} for more details.")
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution.")

# Short notices as their licenses give them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": _GPL.format("General Public License", 3, "General Public License"),
    "GPL-2.0-header": _GPL.format("General Public License", 2, "General Public License"),
    "LGPL-3.0-header": _GPL.format("Lesser General Public License", 3, "Lesser General Public License"),
    "LGPL-2.1-header": _GPL.format("Lesser General Public License", 2.1, "Lesser General Public License"),
    "AGPL-3.0-header": _GPL.format("Affero General Public License", 3, "Affero General Public License"),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "BSD-2-Clause": _BSD,
    "BSD-3-Clause": _BSD + (
        " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."),
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."),
}

# Phrases that a report of a template must have, word for word.
REQUIRED = {
    "Apache-2.0": ("Apache", "2.0"), "Apache-2.0-header": ("Apache License", "Version 2.0"),
    "CC-BY-4.0": ("CC BY 4.0",), "CC-BY-NC-4.0": ("CC BY-NC 4.0",), "CC-BY-SA-4.0": ("CC BY-SA 4.0",),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0",), "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0",),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0",),
    "GPL-3.0": ("GNU General Public", "3"), "GPL-3.0-header": ("GNU General Public", "version 3 of"),
    "GPL-2.0-header": ("GNU General Public", "version 2 of"),
    "LGPL-3.0-header": ("GNU Lesser General Public", "version 3 of"),
    "LGPL-2.1-header": ("GNU Lesser General Public", "version 2.1 of"),
    "AGPL-3.0-header": ("GNU Affero General Public", "version 3 of"),
    "MPL-2.0-header": ("Mozilla Public", "2.0"), "BSD-3-Clause": ("endorse or promote",), "MIT": ("MIT",),
}


def _hashes(text: str) -> np.ndarray:
    return W.words_of(next(W.runs(pa.array([text]))), W.ALNUM, W.LOWER).hash


class Index:
    """Words of the templates and the inverted index of their fingerprints."""

    def __init__(self, templates: Mapping[str, str], required: Mapping[str, Sequence[str]] = REQUIRED):
        self.names = sorted(templates)
        self.required = [[_hashes(x) for x in required.get(name, ())] for name in self.names]
        self.words: list[np.ndarray] = []
        keys, owners, places = [], [], []
        for number, name in enumerate(self.names):
            run = next(W.runs(pa.array([templates[name]])))
            words = W.words_of(run, W.ALNUM, W.LOWER)
            self.words.append(words.hash)
            count = len(words.hash)
            if not count:
                continue
            size = _gram_size(count)
            grams = _grams(words, size)[:count - size + 1]
            width = 1 if count <= SHORT else min(SPAN, len(grams))
            at = np.unique(W.sliding_argmin(grams, width))
            keys.append(grams[at])
            owners.append(np.full(len(at), number))
            places.append(at)
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        # The first template of the same words.
        first: dict[bytes, int] = {}
        self.same = [first.setdefault(w.tobytes(), number) for number, w in enumerate(self.words)]
        self.bands = np.minimum(BAND, np.maximum(1, self.sizes // 8))
        keys, owners, places = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, owners, places))
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners, self.places = keys[order].astype(np.uint64), owners[order], places[order]
        # Sizes of grams in use: short templates have shorter ones.
        self.grams = sorted({_gram_size(int(s)) for s in self.sizes if s})

    def told(self, owner: int, span: np.ndarray) -> bool:
        """Whether the words have all phrases of the template."""
        return all(any(np.array_equal(span[i:i + len(x)], x) for i in np.flatnonzero(span == x[0]))
                   for x in self.required[owner])

    def hits(self, words: W.Words):
        """(word, template, place in it) of all grams that are fingerprints."""
        found = []
        for size in self.grams:
            grams = _grams(words, size)
            low = np.searchsorted(self.keys, grams, "left")
            count = np.searchsorted(self.keys, grams, "right") - low
            count[~W.gram_valid(words, size)] = 0
            at = np.repeat(np.arange(len(grams)), count)
            slot = np.repeat(low, count) + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
            found.append((at, self.owners[slot], self.places[slot]))
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*found))

    def candidates(self, words: W.Words):
        """(text, template, least and greatest diagonal)."""
        at, owner, place = self.hits(words)
        if not len(at):
            return []
        text = np.searchsorted(words.bounds, at, "right") - 1
        diagonal = at - place
        strip = diagonal // (self.bands[owner] + 1)
        order = np.lexsort((at, strip, owner, text))
        text, owner, at, diagonal, strip = (x[order] for x in (text, owner, at, diagonal, strip))
        new = np.ones(len(at), bool)
        new[1:] = ((text[1:] != text[:-1]) | (owner[1:] != owner[:-1])
                   | (strip[1:] != strip[:-1])
                   | (at[1:] - at[:-1] > self.sizes[owner[1:]]))
        first = np.flatnonzero(new)
        return list(zip(
            text[first].tolist(), owner[first].tolist(),
            np.minimum.reduceat(diagonal, first).tolist(), np.maximum.reduceat(diagonal, first).tolist()))


def _gram_size(count: int) -> int:
    """Words of a gram: what lacks the words that COVERAGE lets go leaves one gram whole."""
    lost = count - math.ceil(COVERAGE * count)
    return max(1, min(GRAM, (count - lost) // (lost + 1)))


def _grams(words: W.Words, size: int) -> np.ndarray:
    return W.gram_hashes(words, size)


def align(template: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Longest common subsequence of template word i and text words i + d, low <= d <= high:
    matched words, and the first and last of them in the text (one past)."""
    width, n = high - low + 1, len(template)
    wide = np.zeros(n + width, np.uint64)
    known = np.zeros(n + width, bool)
    places = np.arange(n + width) + low
    ok = (places >= 0) & (places < len(text))
    wide[ok], known[ok] = text[places[ok]], True
    rows = np.zeros((n + 1, width + 1), np.int32)
    # Cell j of line i: template words before i, text words up to i - 1 + low + j.
    for i in range(1, n + 1):
        same = (wide[i - 1:i - 1 + width] == template[i - 1]) & known[i - 1:i - 1 + width]
        best = np.maximum(rows[i - 1, :width] + same, rows[i - 1, 1:width + 1])
        rows[i, :width] = np.maximum.accumulate(best)
        rows[i, width] = rows[i, width - 1]
    i, j = n, width - 1
    matched, first, last = int(rows[n, width - 1]), -1, -1
    while i > 0 and j >= 0 and rows[i, j]:
        if j > 0 and rows[i, j - 1] == rows[i, j]:
            j -= 1
        elif rows[i - 1, j + 1] == rows[i, j]:
            i, j = i - 1, j + 1
            j = min(j, width - 1) if j < width else width - 1
        else:
            place = i - 1 + low + j
            last = place + 1 if last < 0 else last
            first = place
            i -= 1
    return matched, first, last


def _scan(shared, names):
    def batch_scan(batches):
        index: Index = shared.value
        for batch in batches:
            lists: list[list] = []
            for run in W.runs(batch.column(0)):
                words = W.words_of(run, W.ALNUM, W.LOWER)
                found: list[dict[tuple, tuple]] = [{} for _ in range(run.count)]
                for text, owner, low, high in index.candidates(words):
                    base, end = words.bounds[text], words.bounds[text + 1]
                    template, band = index.words[owner], int(index.bands[owner])
                    matched, first, last = align(
                        template, words.hash[base:end], low - base - band, high - base + band)
                    if matched >= COVERAGE * len(template) and index.told(
                            owner, words.hash[base + first:base + last]):
                        found[text].setdefault((first, last, owner), (matched, len(template)))
                for text, own in enumerate(found):
                    ranked = sorted(own.items(), key=lambda x: (-x[1][0], -x[1][1], index.names[x[0][2]]))
                    # Which template has taken each word; templates of the same words share theirs.
                    taken = np.full(words.bounds[text + 1] - words.bounds[text] if own else 0, -1, np.int32)
                    kept: list[dict] = []
                    for (first, last, owner), (matched, size) in ranked:
                        span, same = taken[first:last], index.same[owner]
                        if ((span == -1) | (span == same)).all():
                            span[:] = same
                            kept.append({"license": index.names[owner], "low": first, "high": last,
                                         "matched": matched, "coverage": matched / size})
                    lists.append(sorted(kept, key=lambda k: (k["low"], k["license"])))
            kind = pa.list_(pa.struct([("license", pa.string()), ("low", pa.int32()), ("high", pa.int32()),
                                       ("matched", pa.int32()), ("coverage", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(lists, kind)], names=names)

    return batch_scan


def with_licenses(docs: DataFrame, templates: Mapping[str, str] | None = None, text_col: str = "text",
                  found_col: str = "licenses", required: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """The other columns of ``docs`` with the licenses found: name, span of words (one past
    its end), matched words and their share of the template."""
    if required is None:
        required = REQUIRED if templates is None else {}
    templates = TEMPLATES if templates is None else templates
    if sum(len(t.encode()) for t in templates.values()) > TEMPLATE_BYTES:
        raise ValueError(f"templates of more than {TEMPLATE_BYTES} bytes")
    shared = prepared(docs.sparkSession).sparkContext.broadcast(Index(templates, required))
    rest = [c for c in docs.columns if c not in (text_col, found_col)]
    inner = docs.select(F.col(f"`{text_col}`").alias("x"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    schema = inner.drop("x").withColumn("found", F.lit(None).cast(FOUND)).schema
    out = inner.mapInArrow(_scan(shared, schema.names), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], F.col("found").alias(found_col))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the licenses in it, the best coverage, and the spans."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = with_licenses(docs)
    names = F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["license"])))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_found"),
                        F.concat_ws(",", names).alias("names"),
                        F.array_max(F.transform("licenses", lambda x: x["coverage"])).alias("coverage"), "licenses")
