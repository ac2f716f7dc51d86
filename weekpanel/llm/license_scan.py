"""License scans: winnowed template fingerprints, then banded alignment.

Templates are a small given table. Their word k-grams are winnowed (Schleimer et
al., 2003: the smallest hash of every window of k-grams) into an inverted index
that goes to all tasks; the corpus is scanned once and never shuffled. Texts that
hold a fingerprint become candidates of its template, and the template is
aligned in a band around the diagonals of the fingerprints found. A place counts
where the matched words reach ``least`` of the template and its telling phrases
(version, variant) stand in the span. Where spans of several templates cover the
same words, the one with the most matched words less inserted ones is reported:
sister licenses differ by a word or two, and only one of them is meant."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekpanel.llm.align import align, clusters
from weekpanel.llm.hashing import NO_LETTER, shingles, text_views, word_hashes

GRAM, WINDOW = 3, 3  # any 5 words in a row shared with a template hold a fingerprint
LEAST = 0.8

# fixed values: public license notices and texts
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-2.1-notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND-4.0-short": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-SA-4.0-short": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0-short": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-ND-4.0-notice": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-NC-4.0-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-NC-ND-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
    " distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
    " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by"
    " applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT"
    " WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
    " permissions and limitations under the License.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
    " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
    " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have"
    " received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
    " files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy,"
    " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software"
    " is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be"
    " included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY"
    " KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND"
    " NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER"
    " IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
    " DEALINGS IN THE SOFTWARE.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
    " provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND"
    " THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
    " IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER"
    " RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT"
    " OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions"
    " and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of"
    " conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions"
    " and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of"
    " conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither"
    " the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this"
    " software without specific prior written permission.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,"
    " compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or"
    " non-commercial, and by any means.",
}

# fixed values: the free-software headers of one wording, by the license's full name and version
_GNU_HEADER = TEMPLATES["GPL-3.0-header"]
for _name, _title, _version in (("GPL-2.0-header", "GNU General Public License", "2"), ("LGPL-3.0-header", "GNU Lesser General Public License", "3"),
                                ("LGPL-2.1-header", "GNU Lesser General Public License", "2.1"), ("AGPL-3.0-header", "GNU Affero General Public License", "3")):
    TEMPLATES[_name] = _GNU_HEADER.replace("GNU General Public License", _title).replace("version 3", f"version {_version}")

# fixed values: phrases without which a place is not this license, whatever its coverage
TELLING = {
    "MIT-notice": ("MIT",),
    "Apache-2.0-notice": ("Apache License", "2.0"),
    "Apache-2.0-header": ("Apache License", "Version 2.0"),
    "GPL-3.0-notice": ("GNU General Public License", "version 3"),
    "GPL-2.0-notice": ("GNU General Public License", "version 2"),
    "LGPL-3.0-notice": ("Lesser General", "version 3"),
    "LGPL-2.1-notice": ("Lesser General", "version 2.1"),
    "AGPL-3.0-notice": ("Affero General", "version 3"),
    "GPL-3.0-header": ("GNU General Public License", "version 3"),
    "GPL-2.0-header": ("GNU General Public License", "version 2"),
    "LGPL-3.0-header": ("Lesser General", "version 3"),
    "LGPL-2.1-header": ("Lesser General", "version 2.1"),
    "AGPL-3.0-header": ("Affero General", "version 3"),
    "CC-BY-4.0-short": ("CC BY", "4.0"),
    "CC-BY-SA-4.0-short": ("CC BY-SA", "4.0"),
    "CC-BY-ND-4.0-short": ("CC BY-ND", "4.0"),
    "CC-BY-NC-4.0-notice": ("CC BY-NC", "4.0"),
    "CC-BY-NC-SA-4.0-short": ("CC BY-NC-SA", "4.0"),
    "CC-BY-NC-ND-4.0-short": ("CC BY-NC-ND", "4.0"),
    "CC-BY-4.0-notice": ("Attribution", "4.0"),
    "CC-BY-SA-4.0-notice": ("Attribution-ShareAlike", "4.0"),
    "CC-BY-ND-4.0-notice": ("Attribution-NoDerivatives", "4.0"),
    "CC-BY-NC-4.0-long": ("Attribution-NonCommercial", "4.0"),
    "CC-BY-NC-SA-4.0-notice": ("NonCommercial-ShareAlike", "4.0"),
    "CC-BY-NC-ND-4.0-notice": ("NonCommercial-NoDerivatives", "4.0"),
    "BSD-notice": ("BSD",),
    "MPL-2.0-notice": ("Mozilla Public License", "2.0"),
    "BSD-3-Clause": ("Neither the name of",),
}

SPAN = T.StructType([T.StructField(n, t) for n, t in (
    ("license", T.StringType()), ("coverage", T.DoubleType()), ("start", T.LongType()), ("end", T.LongType()))])
_ARROW = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash (rightmost on ties) of every window."""
    if len(hashes) <= window:
        return np.array([len(hashes) - 1 - int(np.argmin(hashes[::-1]))]) if len(hashes) else np.zeros(0, int)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.unique(np.arange(len(views)) + window - 1 - np.argmin(views[:, ::-1], axis=1))


class Fingerprints:
    """Inverted index from fingerprint to (template, place)."""

    def __init__(self, templates: dict, gram: int, window: int, telling: dict | None = None):
        hashed = lambda t: word_hashes(np.frombuffer(t.encode(), np.uint8), NO_LETTER)
        self.names = list(templates)
        self.words = [hashed(t) for t in templates.values()]
        self.telling = [[hashed(p) for p in (telling or {}).get(n, ())] for n in self.names]
        self.lengths = sorted({min(gram, len(w)) for w in self.words if len(w)})
        postings: dict = {}
        for k, w in enumerate(self.words):
            g = shingles(w, gram)
            for p in winnow(g, window).tolist():
                postings.setdefault(int(g[p]), []).append((k, p))
        self.keys = np.array(sorted(postings), np.uint64)
        self.postings = [postings[int(x)] for x in self.keys]

    def candidates(self, words: np.ndarray) -> dict:
        """Template to the diagonals of its fingerprints in a text."""
        found: dict = {}
        for n in self.lengths:
            if len(words) >= n and len(self.keys):
                g = shingles(words, n)
                x = np.minimum(np.searchsorted(self.keys, g), len(self.keys) - 1)
                for at in np.flatnonzero(self.keys[x] == g).tolist():
                    for k, p in self.postings[x[at]]:
                        found.setdefault(k, []).append(at - p)
        return found

    def told(self, k: int, words: np.ndarray) -> bool:
        """Whether all telling phrases of template ``k`` stand in ``words``."""
        return all(len(p) <= len(words) and (np.lib.stride_tricks.sliding_window_view(words, len(p)) == p).all(axis=1).any() for p in self.telling[k])

    def places(self, words: np.ndarray, least: float) -> list:
        """(template, alignment) of every place that reaches ``least``, one for each stretch of words, by place."""
        found = []
        for k, diagonals in sorted(self.candidates(words).items()):
            w, last = self.words[k], None
            for middle, band in clusters(np.array(diagonals), len(w)):
                x = align(w, words, middle, band)
                if not x or x.coverage(len(w)) < least or not self.told(k, words[x.b_start : x.b_end]):
                    continue
                if last and x.b_start < last.b_end:  # two bands on one place: the better one stays
                    if x.matched <= last.matched:
                        continue
                    found.pop()
                last = x
                found.append((k, x))
        return resolve(found, len(words))

    def spans(self, text: np.ndarray, least: float) -> list:
        words, starts, ends = word_hashes(text, NO_LETTER, spans=True)
        out = self.places(words, least)
        if not out:
            return []
        chars = np.concatenate(([0], np.cumsum((text & 0xC0) != 0x80)))  # code points before each byte
        return [{"license": self.names[k], "coverage": x.coverage(len(self.words[k])),
                 "start": int(chars[starts[x.b_start]]), "end": int(chars[ends[x.b_end - 1]])} for k, x in out]


def resolve(found: list, n_words: int) -> list:
    """The places that stay where several templates cover the same words.

    Places come by matched words less inserted ones, then coverage of the span, place and
    template; one of which more than half the words are taken already goes."""
    if len(found) < 2:
        return found

    def rank(place):
        k, x = place
        return x.columns - (x.a_end - x.a_start) - x.matched, x.b_end - x.b_start, x.b_start, k

    taken, out = np.zeros(n_words, bool), []
    for k, x in sorted(found, key=rank):
        span = taken[x.b_start : x.b_end]
        if 2 * np.count_nonzero(span) <= len(span):
            span[:] = True
            out.append((k, x))
    return sorted(out, key=lambda p: (p[1].b_start, p[0]))


def mark_licenses(docs: DataFrame, templates: dict | None = None, least: float = LEAST, gram: int = GRAM, window: int = WINDOW,
                  telling: dict | None = None) -> DataFrame:
    """``docs`` plus ``licenses``: an array of (license, coverage, start, end), offsets in characters.

    ``docs`` needs text; all its columns pass through (one named licenses is replaced). ``templates``
    maps names to texts, a table of bounded size given by the caller, and ``telling`` names to phrases that have to
    stand in a place (by default those of the own templates). Of templates on the same words one is reported. Words are
    runs of letters, digits and non-ASCII bytes with A-Z folded; templates with fewer than ``gram``
    words are one fingerprint, templates without words never match. Null and empty texts have empty
    arrays; repeated rows are marked alike; a template may occur many times in a text. Empty table: no rows."""
    docs = docs.drop("licenses")
    if templates is None:
        templates, telling = TEMPLATES, TELLING if telling is None else telling
    sent = docs.sparkSession.sparkContext.broadcast(Fingerprints(templates, gram, window, telling))

    def mark(batches):
        for batch in batches:
            found = [sent.value.spans(v, least) for v in text_views(batch.column("text"))]
            yield batch.append_column("licenses", pa.array(found, pa.list_(_ARROW)))

    return docs.mapInArrow(mark, T.StructType([*docs.schema.fields, T.StructField("licenses", T.ArrayType(SPAN))]))


def license_matches(marked: DataFrame) -> DataFrame:
    """(doc_id, license, coverage, n_spans, spans) of a marked table: a row per text and license found."""
    rows = marked.select("doc_id", F.explode(F.transform(F.array_distinct("licenses.license"), lambda n: F.struct(
        n.alias("license"), F.filter("licenses", lambda x: x["license"] == n).alias("found")))).alias("m"))
    return rows.select(
        "doc_id", "m.license", F.array_max("m.found.coverage").alias("coverage"), F.size("m.found").cast("long").alias("n_spans"),
        F.array_sort(F.transform("m.found", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))).alias("spans"))
