"""Licence scans by sentence rules.

A text is cut into sentences; each is normalised (case, quotes, comment signs, white space) and, if it reads like a
known licence sentence, gets that sentence's identifier, with a version where the sentence names one. The sequence of
identifiers is then read from left to right against the licence rules, the first rule in their order that matches at a
place winning, so longer grants come before their parts. Identified sentences that no rule takes are reported as
``unmatched``. Texts without any of the words of which every known sentence has one are not cut.

Null and empty texts have no licences; repeated rows are reported each; very long texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdure.llm.common import batch_of

_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("licenses", pa.string()), ("n_sentences", pa.int64()), ("unmatched", pa.int64()), ("spans", pa.string())]
)
_DDL = "doc_id long, licenses string, n_sentences long, unmatched long, spans string"

#: Every known sentence has one of these, once quotes are taken out; between words there may be a line break and comment signs.
TRIGGER = (
    r"(?i)licen[cs]e|permission|redistribut|copyright|warrant|liab|public\W+domain|spdx"
    r"|\(c\)|©|all\W+rights\W+reserved|creative\W+commons|\bcc(?:0|\W+by\b)"
)

# --- fixed values: known licence sentences, normalised; (?P<v>) is a version -----------------
SENTENCES: list[tuple[str, str]] = [
    ("spdx", r"spdx-license-identifier: ?(?P<v>[a-z0-9.+-]+(?: (?:or|and|with) [a-z0-9.+-]+)*)"),
    ("copyright", r"(?:copyright )?(?:\(c\) |© )?(?:copyright )?(?:\(c\) |© )?\d{4}(?:[-, ]+\d{4})*,? .{1,200}"),
    ("all-rights", r"all rights reserved"),
    ("mit-named", r"(?:this .{1,60} is )?(?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of the )?mit licen[cs]e"),
    ("apache-named", r"(?:this .{1,60} is )?(?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of the )?apache licen[cs]e,? ?(?:version )?v?(?P<v>\d(?:\.\d)?)"),
    ("gpl-named", r"(?:this .{1,60} is )?(?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of the )?gnu general public licen[cs]e,? ?(?:version |v)?(?P<v>\d(?:\.\d)?)"),
    ("lgpl-named", r"(?:this .{1,60} is )?(?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of the )?gnu (?:lesser|library) general public licen[cs]e,? ?(?:version |v)?(?P<v>\d(?:\.\d)?)"),
    ("agpl-named", r"(?:this .{1,60} is )?(?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of the )?gnu affero general public licen[cs]e,? ?(?:version |v)?(?P<v>\d(?:\.\d)?)"),
    ("mpl-named", r"(?:this .{1,60} is )?(?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of the )?mozilla public licen[cs]e,? ?(?:version |v)?(?P<v>\d(?:\.\d)?)"),
    ("bsd-named", r"(?:this .{1,60} is )?(?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of the )?(?:(?P<v>[023])-clause )?bsd(?:-style)? licen[cs]e"),
    ("isc-named", r"(?:this .{1,60} is )?(?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of the )?isc licen[cs]e"),
    ("cc-named", r"(?:this .{1,60} is )?(?:released|licensed|distributed|available|provided) under (?:a |the )?(?:terms of the )?(?:creative commons|cc)[ -](?P<v>by(?:-(?:nc|sa|nd)){0,2}[ -]\d(?:\.\d)?)(?: international| unported)?(?: licen[cs]e)?"),
    ("cc-attribution", r"(?:this .{1,60} is )?(?:released|licensed|distributed|available|provided) under (?:a |the )?creative commons attribution(?P<v>(?:-noncommercial)?(?:-sharealike|-noderivatives)? \d(?:\.\d)?)(?: international| unported)?(?: licen[cs]e)?"),
    ("cc0-named", r"(?:this .{1,60} is )?(?:released|licensed|distributed|available|provided) under (?:the )?(?:creative commons )?cc0(?: ?1\.0)?(?: universal)?(?: licen[cs]e)?"),
    ("mit-grant", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files \(the software\), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so, subject to the following conditions:?"),
    ("mit-notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-as-is", r"the software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement"),
    ("mit-liability", r"in no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software"),
    ("isc-grant", r"permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc-as-is", r"the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("bsd-grant", r"redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:?"),
    ("bsd-source", r"(?:[\d*.-]+ )?redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd-binary", r"(?:[\d*.-]+ )?redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd-endorse", r"(?:[\d*.-]+ )?neither the name of .{1,100} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-as-is", r"this software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("apache-header", r"licensed under the apache license, version 2\.0 \(the license\); you may not use this file except in compliance with the license"),
    ("apache-copy", r"you may obtain a copy of the license at (?:https?://www\.apache\.org/licenses/license-2\.0)?"),
    ("apache-as-is", r"unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an as is basis, without warranties or conditions of any kind, either express or implied"),
    ("apache-limits", r"see the license for the specific language governing permissions and limitations under the license"),
    ("gpl-or-later", r"this program is free software[:;] you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation[,;] either version (?P<v>\d) of the license, or \(at your option\) any later version"),
    ("lgpl-or-later", r"this library is free software[:;] you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation[,;] either version (?P<v>\d(?:\.\d)?) of the license, or \(at your option\) any later version"),
    ("agpl-or-later", r"this program is free software[:;] you can redistribute it and/or modify it under the terms of the gnu affero general public license as published by the free software foundation[,;] either version (?P<v>\d) of the license, or \(at your option\) any later version"),
    ("gpl-hope", r"this (?:program|library) is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl-details", r"see the gnu (?:lesser |affero )?general public license for more details"),
    ("gpl-copy", r"you should have received a copy of the gnu (?:lesser |affero )?general public license along with this (?:program|library).{0,200}"),
    ("mpl-header", r"this source code form is subject to the terms of the mozilla public license, v\. (?P<v>\d\.\d)"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("zlib-as-is", r"this software is provided as-is, without any express or implied warranty"),
    ("zlib-grant", r"permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:?"),
    ("boost-named", r"distributed under the boost software license, version (?P<v>\d\.\d)"),
]

#: Licence rules in the order in which they are tried: the name (``{v}``: the version) and the sequence of identifiers,
#: ``?`` after one that may be missing.
RULES: list[tuple[str, list[str]]] = [
    ("{v}", ["spdx"]),
    ("MIT", ["mit-grant", "mit-notice?", "mit-as-is?", "mit-liability?"]),
    ("ISC", ["isc-grant", "isc-as-is?"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is?"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is?"]),
    ("Apache-2.0", ["apache-header", "apache-copy?", "apache-as-is?", "apache-limits?"]),
    ("Apache-{v}", ["apache-named"]),
    ("GPL-{v}-or-later", ["gpl-or-later", "gpl-hope?", "gpl-details?", "gpl-copy?"]),
    ("LGPL-{v}-or-later", ["lgpl-or-later", "gpl-hope?", "gpl-details?", "gpl-copy?"]),
    ("AGPL-{v}-or-later", ["agpl-or-later", "gpl-hope?", "gpl-details?", "gpl-copy?"]),
    ("GPL-{v}", ["gpl-named"]),
    ("LGPL-{v}", ["lgpl-named"]),
    ("AGPL-{v}", ["agpl-named"]),
    ("MPL-{v}", ["mpl-header"]),
    ("MPL-{v}", ["mpl-named"]),
    ("Zlib", ["zlib-as-is?", "zlib-grant"]),
    ("BSL-{v}", ["boost-named"]),
    ("Unlicense", ["unlicense"]),
    ("BSD-{v}-Clause", ["bsd-named"]),
    ("ISC", ["isc-named"]),
    ("CC0-1.0", ["cc0-named"]),
    ("CC-{v}", ["cc-named"]),
    ("CC-BY{v}", ["cc-attribution"]),
    ("MIT", ["mit-named"]),
]
# ----------------------------------------------------------------------------------------------

_PATTERNS = [(name, re.compile(pattern)) for name, pattern in SENTENCES]
_END = re.compile(r"(?<=[.!?])\s+|(?<=:)[ \t]*\n|\n[ \t]*(?:#+|//+|\*+|--|;+|>)?[ \t]*(?=\n)")
_SIGNS = re.compile(r"(?m)^[ \t]*(?:(?:#+|//+|/?\*+/?|--|;+|>)[ \t]*)+")
QUOTES = "\"'`“”‘’"
_QUOTES = re.compile(f"[{QUOTES}]")
_TRIGGER = re.compile(TRIGGER)
#: A year and some text are a copyright line only with one of these.
_NOTICE = re.compile(r"(?i)licen[cs]e|permission|redistribut|copyright|warrant|liab|public domain|spdx|\(c\)|©")
#: A line of years and nothing else.
_YEARS = re.compile(r"\d{4}(?:[-, ]+\d{4})*,?")
#: Sentences that end in any text.
_OPEN = {name for name, pattern in SENTENCES if re.search(r"\.\{\d+,\d+\}$", pattern)}
#: Tells whether a normalised start can still become a known sentence.
_BEGINNING = regex.compile("|".join(f"(?:{re.sub(r'\?P<v>', '?:', pattern)})" for _, pattern in SENTENCES))


@dataclass
class Sentence:
    name: str
    version: str
    start: int
    end: int


def _plain(text: str) -> str:
    return _QUOTES.sub("", _SIGNS.sub(" ", text)).lower()


def normalised(sentence: str) -> str:
    return " ".join(_plain(sentence).split()).strip(" .!")


def identify(sentence: str) -> tuple[str, str] | None:
    """The identifier and version of a known sentence."""
    if not _TRIGGER.search(_QUOTES.sub("", sentence)):
        return None
    return _named(normalised(sentence), sentence)


def _named(plain: str, sentence: str) -> tuple[str, str] | None:
    """The identifier and version of a normalised sentence; ``sentence`` is the text it comes from, or a line end for several lines."""
    for name, pattern in _PATTERNS:
        found = pattern.fullmatch(plain)
        if found and name == "copyright" and not _NOTICE.search(plain):
            continue
        # a tag ends with its line
        if found and not (name == "spdx" and "\n" in (sentence.strip() or sentence)):
            version = (found.groupdict().get("v") or "").strip()
            # identifiers keep their case
            at = sentence.lower().find(version) if name == "spdx" else -1
            return name, sentence[at : at + len(version)] if at >= 0 else version
    return None


def sentences(text: str) -> Iterator[Sentence]:
    """Known sentences with their places; of several lines between sentence ends, all runs of lines are tried."""
    at = 0
    for end in [*((m.start(), m.end()) for m in _END.finditer(text)), (len(text), len(text))]:
        part = text[at : end[0]]
        if "\n" in part:
            yield from _from_lines(part, at)
        elif known := identify(part):
            yield Sentence(*known, at, end[0])
        at = end[1]


def _from_lines(part: str, at: int) -> Iterator[Sentence]:
    """Known sentences that are runs of lines of a part, the longest from the first line on that starts one."""
    if not _TRIGGER.search(_QUOTES.sub("", part)):
        return
    lines = part.split("\n")
    starts = [0, *accumulate(len(line) + 1 for line in lines)]
    units = _units([" ".join(_plain(line).split()) for line in lines])
    # the last unit first, since a sentence with an open end stops before the next known one
    runs: list[tuple[tuple[str, str], int] | None] = [None] * len(units)
    for i in reversed(range(len(units))):
        begun, stopped = "", False
        for j in range(i, len(units)):
            if not units[j].plain:
                # signs alone neither start a sentence nor go on with one
                if j == i:
                    break
                continue
            begun = f"{begun} {units[j].plain}".lstrip(" .!")
            stopped = stopped or (j > i and runs[j] is not None)
            if j == i and units[i].first == units[i].last:
                known = identify(lines[units[i].first])
            else:
                known = _named(begun.strip(" .!"), "\n") if _TRIGGER.search(begun) else None
            if known and not (stopped and known[0] in _OPEN):
                runs[i] = known, j
            if not _BEGINNING.fullmatch(begun + " ", partial=True):
                break
    i = 0
    while i < len(units):
        if runs[i]:
            known, j = runs[i]
            yield Sentence(*known, at + starts[units[i].first], at + starts[units[j].last + 1] - 1)
            i = j
        i += 1


@dataclass
class Unit:
    """Lines that matching takes in one step, and their normalised text."""

    first: int
    last: int
    plain: str


def _units(plain: list[str]) -> list[Unit]:
    """Lines as units: a column of years is one, read as its first and last line, and so are lines of signs in a row.

    Known sentences have a bounded length but for their lists of years, so a walk over units ends after a bounded number
    of them, and a column of years is entered at its top only.
    """
    units: list[Unit] = []
    column = False
    for k, text in enumerate(plain):
        years = bool(_YEARS.fullmatch(text))
        if years and column:
            # signs between the years belong to the column
            if not units[-1].plain:
                units.pop()
            head = units[-1].plain.split(" ", 1)[0]
            units[-1] = Unit(units[-1].first, k, f"{head} {text.rsplit(' ', 1)[-1]}")
        elif not text and units and not units[-1].plain:
            units[-1].last = k
        else:
            units.append(Unit(k, k, text))
            column = years or (column and not text)
    return units


def _version(name: str, version: str) -> str:
    if name == "cc-attribution":
        return version.replace("noncommercial", "NC").replace("sharealike", "SA").replace("noderivatives", "ND").replace(" ", "-")
    if name == "cc-named":
        return version.replace(" ", "-").upper()
    if name == "spdx":
        return version
    if name == "bsd-named":
        return version or "unspecified"
    return version if "." in version else f"{version}.0"


def _matched(rule: list[str], found: list[Sentence], at: int) -> int:
    """The number of sentences from ``at`` that the rule takes; 0 if it does not match."""
    taken = 0
    for step in rule:
        here = found[at + taken].name if at + taken < len(found) else None
        if here == step.removesuffix("?"):
            taken += 1
        elif not step.endswith("?"):
            return 0
    return taken


def licences(found: list[Sentence]) -> tuple[list[tuple[str, int, int]], int]:
    """(licence, start, end) in the order of the text, and the number of sentences that no rule took."""
    out, unmatched, at = [], 0, 0
    while at < len(found):
        for name, rule in RULES:
            taken = _matched(rule, found, at)
            if taken:
                own = found[at : at + taken]
                version = next((_version(s.name, s.version) for s in own if s.version or s.name == "bsd-named"), "")
                out.append((name.format(v=version), own[0].start, own[-1].end))
                at += taken
                break
        else:
            unmatched += found[at].name not in ("copyright", "all-rights")
            at += 1
    return out, unmatched


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            known = list(sentences(text))
            found, unmatched = licences(known)
            names = ",".join(dict.fromkeys(name for name, _, _ in found))
            rows.append((doc, names, len(known), unmatched, ",".join(f"{n}:{a}:{b}" for n, a, b in found)))
        yield batch_of(_SCHEMA, *(zip(*rows, strict=True) if rows else [[]] * len(_SCHEMA)))


def hinted(text: str) -> Column:
    """True for texts that can have a known sentence."""
    plain = reduce(lambda c, quote: F.replace(c, F.lit(quote), F.lit("")), QUOTES, F.col(text))
    return F.coalesce(plain.rlike(TRIGGER), F.lit(False))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, licenses, n_sentences, unmatched, spans) for every row of ``docs`` (doc_id, text).

    ``licenses`` lists the different licences in the order of their first place, ``spans`` all places as
    ``licence:start:end`` (code points, end exclusive). Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    told = hinted("text")
    none = [F.lit("").alias("licenses"), F.lit(0).cast("long").alias("n_sentences"), F.lit(0).cast("long").alias("unmatched"), F.lit("").alias("spans")]
    return rows.where(~told).select("doc_id", *none).unionByName(rows.where(told).mapInArrow(_scan, _DDL))
