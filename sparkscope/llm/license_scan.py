"""License notices in texts: MinHash over overlapping windows retrieves templates, containment verifies.

Texts and templates are shingles of ``SHINGLE`` words. Documents are cut into blocks of
eight shingles; a window is two neighbouring runs of 1, 2, 4, ... blocks, so every passage
of up to a run's length lies whole in some window of its length class. Each band is the
minimum of one hash of a window's shingles (one row per band). Templates are looked up by
the minima of their own shingles in the windows of their length class.

A window that contains the needed share of a template has a Jaccard similarity J to it
that follows from the two lengths, and meets it in one band with probability J. The number
of bands is chosen so that the most unfavourable template is met with probability
``certainty``. What is met is verified exactly: the distinct shingles of the template in
the window must be at least ``containment`` of all of its shingles.

Templates are a reference list that every task holds; more than ``MAX_TEMPLATE_BYTES`` of
text is an error, not a cut. Documents are never shuffled.

Defined results: null and empty texts have no matches. Overlapping finds of one template
in a text are one match, with the largest containment. Templates without id or of fewer
words than a shingle are ignored; equal templates are reported each under its id. Repeated
rows each give their matches, texts of any length are scanned whole, other columns are
ignored. Empty tables on either side give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkscope.llm.common import ship
from sparkscope.llm.textkit import Words, blocks, ngrams, text_values

SHINGLE = 3
BLOCK = 8
CONTAINMENT = 0.8
CERTAINTY = 0.999
MAX_TEMPLATE_BYTES = 16 << 20
#: Words: letters, digits and everything beyond ASCII.
WORD_BYTES = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])

# Notices as licenses ask for them.
NOTICES = [
    ("apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit-line", "Released under the MIT License."),
    ("mit-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("gpl-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
     "any later version."),
    ("lgpl-line", "This library is licensed under the GNU Lesser General Public License."),
    ("bsd-3-clause-conditions", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met"),
    ("mpl-2.0-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
     "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("cc-by-4.0-line", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0-line", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0-line", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("all-rights-reserved", "All rights reserved. No part of this publication may be reproduced without permission."),
]


_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"""
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT
NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES
OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

# Whole texts of short licenses, and the tags that files carry instead of a text.
LICENSES = [
    ("mit", f"{_MIT_GRANT}, subject to the following conditions: The above copyright notice and this permission notice shall be included in "
     f"all copies or substantial portions of the Software. {_AS_IS}"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
     f"that the above copyright notice and this permission notice appear in all copies. {_ISC_END}"),
    ("0bsd", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
     f"{_ISC_END}"),
    ("bsd-2-clause", f"{_BSD} {_BSD_END}"),
    ("bsd-3-clause", f"{_BSD} {_BSD_THIRD} {_BSD_END}"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
     "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
     "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not "
     "be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in "
     "the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must "
     "not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
     "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
     "non-commercial, and by any means."),
    *((f"spdx-{x.lower()}", f"SPDX-License-Identifier: {x}") for x in (
        "Apache-2.0", "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
        "LGPL-2.1-only", "LGPL-3.0-only", "AGPL-3.0-only", "MPL-2.0", "EPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "Unlicense")),
]


class Templates:
    """Shingles and band minima of the templates, by length class."""

    def __init__(self, notices: list[tuple[str, str]], containment: float, certainty: float):
        self.containment = containment
        self.names, self.shingles = [], []
        for name, text in notices:
            words = Words([text.encode()], WORD_BYTES)
            if len(words) >= SHINGLE:
                self.names.append(name)
                self.shingles.append(np.unique(ngrams(words.hashes(), SHINGLE)))
        self.sizes = np.array([len(x) for x in self.shingles], np.int64)
        #: A passage of n shingles may lie anywhere: its class's runs have n or more.
        self.level = np.array([max(0, (int(n) - 1) // BLOCK).bit_length() for n in self.sizes], np.int64)
        bands = 1
        for n, level in zip(self.sizes, self.level, strict=True):
            shared = containment * n
            similarity = shared / (2 * BLOCK * 2.0 ** level + n - shared)
            bands = max(bands, ceil(log(1 - certainty) / log(1 - similarity)))
        self.factors = np.random.default_rng(99).integers(1, 1 << 62, bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.minima: list[dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]] = []
        for factor in self.factors:
            own = {}
            for level in np.unique(self.level):
                at = np.flatnonzero(self.level == level)
                with np.errstate(over="ignore"):
                    values = np.array([(self.shingles[i] * factor).min() for i in at], np.uint64)
                order = np.argsort(values, kind="stable")
                known = np.zeros(1 << 16, bool)
                known[(values >> np.uint64(8)) & np.uint64(0xFFFF)] = True
                own[int(level)] = (values[order], at[order], known)
            self.minima.append(own)


def pairs_of(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minima over neighbouring runs within each document; a document's last run stands alone too."""
    out = values.copy()
    follow = np.ones(len(values), bool)
    follow[np.append(first[1:], len(values)) - 1] = False
    out[:-1] = np.where(follow[:-1], np.minimum(values[:-1], values[1:]), values[:-1])
    return out, follow


def match_block(words: Words, templates: Templates) -> list[tuple[int, int, int, int, float]]:
    """(document, template, first word, last word, containment) of a block of documents."""
    doc = words.doc
    grams = ngrams(words.hashes(), SHINGLE)
    whole = doc[: len(grams)] == doc[SHINGLE - 1: SHINGLE - 1 + len(grams)]
    doc_of = doc[: len(grams)][whole]
    grams = grams[whole]
    if not len(grams) or not templates.names:
        return []
    docs, begin, counts = np.unique(doc_of, return_index=True, return_counts=True)
    runs = -(-counts // BLOCK)  # base blocks of each document
    first_run = np.cumsum(runs) - runs
    run_start = np.repeat(begin, runs) + BLOCK * (np.arange(runs.sum()) - np.repeat(first_run, runs))
    levels = int(templates.level.max()) + 1
    found: set[tuple[int, int, int]] = set()  # (template, level, run)
    layouts = []
    own_runs, own_first = runs, first_run
    for _ in range(levels):
        layouts.append((own_runs, own_first))
        own_runs = -(-own_runs // 2)
        own_first = np.cumsum(own_runs) - own_runs
    for factor, minima in zip(templates.factors, templates.minima, strict=True):
        with np.errstate(over="ignore"):
            values = np.minimum.reduceat(grams * factor, run_start)
        for level in range(levels):
            count, first = layouts[level]
            if level in minima:
                window, _ = pairs_of(values, first)
                wanted, at, known = minima[level]
                for run in np.flatnonzero(known[(window >> np.uint64(8)) & np.uint64(0xFFFF)]):
                    low, high = np.searchsorted(wanted, window[run], "left"), np.searchsorted(wanted, window[run], "right")
                    found.update((int(i), level, int(run)) for i in at[low:high])
            if level + 1 < levels:
                number = np.arange(len(values)) - np.repeat(first, count)
                values = np.minimum.reduceat(values, np.flatnonzero(number % 2 == 0))
    out: dict[tuple[int, int], list[list]] = {}
    for i, level, run in sorted(found):
        count, first = layouts[level]
        d = int(np.searchsorted(first, run, "right") - 1)
        size = BLOCK << level
        low = begin[d] + (run - first[d]) * size
        high = min(low + 2 * size, begin[d] + counts[d])
        place = np.flatnonzero(np.isin(grams[low:high], templates.shingles[i]))
        share = len(np.unique(grams[low:high][place])) / templates.sizes[i]
        if share >= templates.containment - 1e-9:
            start = int(low - begin[d])
            out.setdefault((int(docs[d]), i), []).append([start + int(place[0]), start + int(place[-1]) + SHINGLE - 1, share])
    rows = []
    for (d, i), finds in out.items():
        merged: list[list] = []
        for low, high, share in sorted(finds):
            if merged and low <= merged[-1][1]:
                merged[-1][1:] = [max(merged[-1][1], high), max(merged[-1][2], share)]
            else:
                merged.append([low, high, share])
        rows += [(d, i, low, high, share) for low, high, share in merged]
    return rows


def license_matches(docs: DataFrame, notices: list[tuple[str, str]] | DataFrame, containment: float = CONTAINMENT,
                    certainty: float = CERTAINTY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, first_word, last_word, containment) for every template found in a text.

    ``notices`` are (id, text) pairs or a table of two such columns.
    """
    if isinstance(notices, DataFrame):
        named = notices.toDF("license", "notice").where("license is not null and notice is not null")
        size = named.agg(F.sum(F.octet_length("notice"))).first()[0] or 0
        if size > MAX_TEMPLATE_BYTES:
            raise ValueError(f"{size} bytes of templates; {MAX_TEMPLATE_BYTES} can be held by every task")
        notices = sorted((str(row[0]), row[1]) for row in named.collect())
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((list(notices), containment, certainty))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(*sent.value)
        names = ["doc_id", "license", "first_word", "last_word", "containment"]
        for batch in batches:
            texts = text_values(batch.column("text"))
            for low, high in blocks(texts):
                rows = sorted(match_block(Words(texts[low:high], WORD_BYTES), templates))
                yield pa.record_batch([
                    batch.column("doc_id").take(pa.array([low + row[0] for row in rows], pa.int64())),
                    pa.array([templates.names[row[1]] for row in rows], pa.string()), pa.array([row[2] for row in rows], pa.int64()),
                    pa.array([row[3] for row in rows], pa.int64()), pa.array([row[4] for row in rows], pa.float64())], names)

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        match, f"doc_id {id_type}, license string, first_word bigint, last_word bigint, containment double")
