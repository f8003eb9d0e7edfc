"""License scans by conditional compression.

Every text is searched for cue words; the words around the cues make blocks. In a
block each template is aligned with the words (case and punctuation aside), and
every stretch where at least ``LEAST_MATCHED`` of the template's words stand in
order, with no more than the remainder's share put in between, is a candidate. A
candidate's bytes are compressed with zstandard, alone and with the template as a
raw dictionary. The size reduction ranks the candidates of the whole text: of those
that overlap, the one whose template explains most bytes comes first.

The exact wording differences confirm or refute a winner: one that differs from its
template in a word that names the license or its version (``IDENTITY``) is refuted
and passes the place on to the next in rank. Where every candidate is refuted the
notice is reported as ``UNKNOWN`` with the nearest template's name. Nothing is cut by
a count or a least saving.

Long texts are scanned whole; blocks of neighbouring cues are merged and cut into
pieces that overlap by more than the longest template.

Defined results: NULL and empty texts and texts without cues have no row; equal
notices at several places are rows of their own; of candidates with equal reductions
the one with fewer differences wins; repeated rows are scanned each; documents
without an id are reported with NULL.
"""

from __future__ import annotations

import difflib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.llm.common import table

# Wordings of license notices, by SPDX identifier.
_GNU = [("GPL", "GNU General Public License", ["2", "3"]),
        ("LGPL", "GNU Library General Public License", ["2"]),
        ("LGPL", "GNU Lesser General Public License", ["2.1", "3"]),
        ("AGPL", "GNU Affero General Public License", ["3"])]
_CREATIVE_COMMONS = [("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"),
                     ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
                     ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                     ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")]
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met")
_BSD_CLAUSES = (
    _BSD + ": 1. Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer. 2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution. ")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted")
_TEXTS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
     "this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", _BSD_CLAUSES + "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS"),
    ("BSD-3-Clause", _BSD),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", _BSD_CLAUSES + "3. Neither the name of the copyright holder nor the names of "
     "its contributors may be used to endorse or promote products derived from this software "
     "without specific prior written permission."),
    ("0BSD", _ISC + "."),
    ("ISC", _ISC + ", provided that the above copyright notice and this permission notice appear "
     "in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
     "v. 2.0."),
    ("GFDL-1.2-or-later", "Permission is granted to copy, distribute and/or modify this document "
     "under the terms of the GNU Free Documentation License, Version 1.2 or any later version"),
    ("GFDL-1.3-or-later", "Permission is granted to copy, distribute and/or modify this document "
     "under the terms of the GNU Free Documentation License, Version 1.3 or any later version"),
    ("CC0-1.0", "Licensed under CC0 1.0."),
]
_TAGS = ["Zlib", "Unlicense", "BSL-1.0", "EPL-2.0", "EUPL-1.2", "MS-PL", "OFL-1.1", "WTFPL"]


def _all_templates() -> list[tuple[str, str]]:
    out = list(_TEXTS)
    for short, name, versions in _GNU:
        for v in versions:
            spdx = f"{short}-{v if '.' in v else v + '.0'}"
            out += [(f"{spdx}-only", f"This work is licensed under the {name}, version {v}."),
                    (f"{spdx}-or-later", f"This work is licensed under the {name}, version {v} or "
                     "later."),
                    (f"{spdx}-or-later", "This program is free software: you can redistribute it "
                     f"and/or modify it under the terms of the {name} as published by the Free "
                     f"Software Foundation, either version {v} of the License, or (at your option) "
                     "any later version.")]
    for short, name in _CREATIVE_COMMONS:
        for v, ported in (("4.0", "International"), ("3.0", "Unported")):
            out += [(f"CC-{short}-{v}", f"Licensed under CC {short} {v}."),
                    (f"CC-{short}-{v}", f"This work is licensed under a Creative Commons {name} "
                     f"{v} {ported} License.")]
    tags = [name for name, _ in out] + _TAGS
    return out + [(t, f"SPDX-License-Identifier: {t}") for t in dict.fromkeys(tags)]


#: (SPDX identifier, wording)
TEMPLATES = _all_templates()
CUES = rb"licen[cs]e|redistribut|hereby granted|free software|cc(?:0| by)"
#: Words that name a license or its version: a difference in one of them refutes a winner.
IDENTITY = re.compile(rb"v?\d{1,2}(\.\d+)*|[23]-clause|by(-[a-z]+)+|attribution.*|noncommercial|"
                      rb"sharealike|noderivatives|international|unported|cc0|apache|mit|bsd|isc|"
                      rb"mozilla|affero|lesser|documentation|later|only|\S*-only|\S*-later")
UNKNOWN = "NOASSERTION"

LEAST_MATCHED = 0.8

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+(?:[.\-][0-9A-Za-z]+)*")


def blocks(text: bytes, cue: re.Pattern, longest: int) -> list[tuple[int, int]]:
    """(start, end) of the stretches around cues, merged, in pieces of bounded size."""
    around, piece = 3 * longest // 2, 6 * longest
    merged: list[list[int]] = []
    for m in cue.finditer(text):
        a, b = max(0, m.start() - around), min(len(text), m.end() + around)
        if merged and a <= merged[-1][1]:
            merged[-1][1] = b
        else:
            merged.append([a, b])
    overlap = 2 * longest
    return [(s, min(b, s + piece)) for a, b in merged
            for s in range(a, max(a + 1, b - overlap), piece - overlap)]


@dataclass(frozen=True)
class Place:
    """Where a template stands among a block's words, and how its wording differs there."""
    first: int
    last: int
    matched: int
    missing: tuple[bytes, ...]
    added: tuple[bytes, ...]
    differences: str

    @property
    def refuted(self) -> bool:
        return (any(IDENTITY.fullmatch(w) for w in self.missing + self.added)
                or b"library" in self.missing)  # a name only in the template: else a plain word


class Scanner:
    """Finds, ranks and confirms the templates in a text."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.cue = re.compile(CUES, re.IGNORECASE)
        self.names = [name for name, _ in templates]
        raw = [wording.encode().lower() for _, wording in templates]
        self.words = [_WORD.findall(t) for t in raw]
        self.bags = [Counter(w) for w in self.words]
        self.longest = max(map(len, raw), default=1)
        options = {"level": 12, "write_content_size": False, "write_checksum": False,
                   "write_dict_id": False}
        self.plain = zstandard.ZstdCompressor(**options)
        self.primed = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(
            t, dict_type=zstandard.DICT_TYPE_RAWCONTENT), **options) for t in raw]
        self.whole = [max(1, self.reduction(t, i)) for i, t in enumerate(raw)]

    def reduction(self, block: bytes, template: int) -> int:
        """Bytes that the template as a dictionary saves when the block is compressed."""
        return len(self.plain.compress(block)) - len(self.primed[template].compress(block))

    def places(self, words: list[bytes], template: int) -> list[Place]:
        """The places that meet the wording rule, none of them overlapping another."""
        wanted, bag = self.words[template], self.bags[template]
        out, rest = [], [(0, len(words))]
        while rest:
            a, b = rest.pop()
            part = words[a:b]
            # fewer of the template's words than the rule asks for, in whatever order
            if (bag & Counter(part)).total() < LEAST_MATCHED * len(wanted):
                continue
            core = difflib.SequenceMatcher(None, wanted, part, autojunk=False).find_longest_match()
            lo = max(0, core.b - 2 * core.a - 2)  # the stretch that the template can take up
            hi = core.b + core.size + 2 * (len(wanted) - core.a - core.size) + 2
            place = self._aligned(wanted, part[lo:hi], a + lo)
            if place:
                out.append(place)
                rest += [(a, place.first), (place.last, b)]
            else:  # the template may stand elsewhere
                rest += [(a, a + core.b), (a + core.b + core.size, b)]
        return out

    @staticmethod
    def _aligned(wanted: list[bytes], found: list[bytes], at: int) -> Place | None:
        match = difflib.SequenceMatcher(None, wanted, found, autojunk=False)
        same = [m for m in match.get_matching_blocks() if m.size]
        matched = sum(m.size for m in same)
        if matched < LEAST_MATCHED * len(wanted):
            return None
        first, last = same[0].b, same[-1].b + same[-1].size
        if last - first - matched > (1 - LEAST_MATCHED) * len(wanted):
            return None
        missing, added, changes = [], [], []
        for kind, i, j, k, m in match.get_opcodes():
            if kind != "equal":
                put = found[max(k, first):min(m, last)]
                missing += wanted[i:j]
                added += put
                changes += [b"-" + w for w in wanted[i:j]] + [b"+" + w for w in put]
        return Place(at + first, at + last, matched, tuple(missing), tuple(added),
                     b" ".join(changes).decode("utf-8", "replace"))

    def candidates(self, text: bytes) -> list[tuple[int, int, int, Place, int]]:
        """(start, end, template, place, bytes saved) of every place of every template."""
        found = {}
        for a, b in blocks(text, self.cue, self.longest):
            spans = [(a + m.start(), a + m.end()) for m in _WORD.finditer(text[a:b])]
            words = [text[s:e].lower() for s, e in spans]
            bag = Counter(words)
            for i, wanted in enumerate(self.bags):
                if (wanted & bag).total() < LEAST_MATCHED * len(self.words[i]):
                    continue
                for place in self.places(words, i):
                    start, end = spans[place.first][0], spans[place.last - 1][1]
                    if (start, end, i) not in found:
                        saved = self.reduction(text[start:end].lower(), i)
                        found[start, end, i] = (start, end, i, place, saved)
        return list(found.values())

    def scan(self, text: bytes) -> list[tuple[int, int, str, float, float, str, str]]:
        """(start, end, license, saved, matched, differences, nearest) of every notice."""
        ranked = sorted(self.candidates(text), key=lambda c: (
            -c[4], len(c[3].missing) + len(c[3].added), c[0], c[2]))
        out: list[tuple] = []
        for unknown in (False, True):  # what no candidate confirms is named by the best refuted one
            for start, end, i, place, saved in ranked:
                if place.refuted == unknown and all(end <= n[0] or n[1] <= start for n in out):
                    out.append((start, end, UNKNOWN if unknown else self.names[i],
                                saved / self.whole[i], place.matched / len(self.words[i]),
                                place.differences, self.names[i]))
        return sorted(out)


def _scanned(templates: list[tuple[str, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            rows, notices = [], []
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                if text and scanner.cue.search(text):
                    for notice in scanner.scan(text):
                        rows.append(i)
                        notices.append(notice)
            columns = list(zip(*notices, strict=True)) or [()] * len(_NOTICE)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.string(),
                     pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())),
                 *[pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]],
                names=[batch.schema.names[0], *_NOTICE])
    return run


_NOTICE = ["start", "end", "license", "saved", "matched", "differences", "nearest"]


def scan_licenses(docs: DataFrame, doc: str = "doc_id", text: str = "text",
                  templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """doc, start, end (bytes), license, saved, matched, differences, nearest: a row a notice.

    The differences list the template's words that are missing (-) and the
    words put in instead (+); empty for an exact wording. ``nearest`` is the
    template's identifier, also where the license is ``NOASSERTION``.
    """
    kind = docs.schema[doc].dataType.simpleString()
    return docs.select(F.col(doc), F.col(text)).mapInArrow(
        _scanned(list(templates)),
        f"`{doc}` {kind}, start bigint, end bigint, license string, saved double, "
        f"matched double, differences string, nearest string")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
