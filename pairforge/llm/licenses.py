r"""License scan: ordered signature rules behind a keyword prefilter.

A text is lower-cased (A-Z only) and cut into words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (ASCII letters and digits,
and every character from U+0080); the rules read the words joined by single spaces, so a rule's span is a range
of words.  Every rule is ``(label, priority, confidence, keywords, regex)``; a rule is tried only where one of its
keywords occurs, and every match of its regex holds one of them.  Detections that lie inside another one of a higher priority, or of the same priority and more words, are
suppressed.  The three base phrases are rules of the top priority and are never suppressed.

The rules come from ``FAMILIES`` (how a license is named) and ``FRAMES`` (the wording around a name): every pair
is one regex, some 300 in all, and ``NOTICES``: openings, headers, operative sentences and exceptions of the licenses
themselves, written one by one.  A text's work grows with its length (n log n of its detections).

Rows: a null text is empty and has no words, places or labels, and score 0.  Results are per row, so repeated
rows give repeated results and an empty table an empty one.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cached_property
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import small_batches

# The base phrases, and how the licenses name themselves (label, patterns of the name).
BASE = (
    (b"under the mit license", "mit"),
    (b"apache license version 2", "apache-2"),
    (b"cc by nc", "cc-by-nc"),
)
FAMILIES = (
    ("mit", r"(?:mit|expat)(?: x11)?"),
    ("apache-2", r"apache(?: software)?(?: license)?(?: version)? (?:v2|v?2 0|2)"),
    ("apache-1.1", r"apache(?: software)?(?: license)?(?: version)? v?1 1"),
    ("bsd-2-clause", r"(?:(?:2|two) clause|simplified|freebsd) bsd|bsd (?:2|two) clause"),
    ("bsd-3-clause", r"(?:(?:3|three) clause|new|modified|revised) bsd|bsd (?:3|three) clause"),
    ("bsd-4-clause", r"(?:(?:4|four) clause|original) bsd|bsd (?:4|four) clause"),
    ("0bsd", r"zero clause bsd|bsd zero clause|0bsd"),
    ("gpl-2", r"(?:gnu )?(?:general public license|gpl)(?: as published by the free software foundation)?(?: either)?(?: version)? (?:v2|v?2 0|2)"),
    ("gpl-3", r"(?:gnu )?(?:general public license|gpl)(?: as published by the free software foundation)?(?: either)?(?: version)? (?:v3|v?3 0|3)"),
    ("lgpl-2.1", r"(?:gnu )?(?:(?:lesser|library) general public license|lgpl)(?: version)? v?2 1"),
    ("lgpl-3", r"(?:gnu )?(?:lesser general public license|lgpl)(?: version)? (?:v3|v?3 0|3)"),
    ("agpl-3", r"(?:gnu )?(?:affero general public license|agpl)(?: version)? (?:v3|v?3 0|3)"),
    ("gfdl", r"gnu free documentation license|gfdl"),
    ("mpl-1.1", r"(?:mozilla public license|mpl)(?: version)? v?1 1"),
    ("mpl-2.0", r"(?:mozilla public license|mpl)(?: version)? v?2 0"),
    ("epl-1.0", r"(?:eclipse public license|epl)(?: version)? v?1 0"),
    ("epl-2.0", r"(?:eclipse public license|epl)(?: version)? v?2 0"),
    ("edl-1.0", r"eclipse distribution license(?: version)? v?1 0"),
    ("cddl-1.0", r"(?:common development and distribution license|cddl)(?: version)?(?: v?1 0)?"),
    ("cpl-1.0", r"common public license(?: version)? v?1 0"),
    ("cecill", r"cecill(?: v?2 1| b| c)?"),
    ("eupl-1.2", r"(?:european union public licen[cs]e|eupl)(?: version)?(?: v)? ?1 2"),
    ("isc", r"isc"),
    ("zlib", r"zlib(?: libpng)?"),
    ("libpng", r"libpng"),
    ("unlicense", r"unlicense"),
    ("wtfpl", r"wtfpl|do what the fuck you want to public license"),
    ("artistic-1", r"artistic license(?: version)? v?1 0"),
    ("artistic-2", r"artistic license(?: version)? v?2 0"),
    ("bsl-1.0", r"boost software license(?: version)?(?: v?1 0)?"),
    ("postgresql", r"postgresql"),
    ("psf-2", r"python software foundation(?: license)?(?: version 2)?"),
    ("php-3", r"php(?: license)?(?: version)? 3 01?"),
    ("ruby", r"ruby s"),
    ("openssl", r"openssl"),
    ("ofl-1.1", r"sil open font license(?: version)?(?: v?1 1)?"),
    ("osl-3.0", r"open software license(?: version)? v?3 0"),
    ("afl-3.0", r"academic free license(?: version)? v?3 0"),
    ("ms-pl", r"microsoft public license"),
    ("ms-rl", r"microsoft reciprocal license"),
    ("ncsa", r"university of illinois ncsa open source license"),
    ("qpl", r"q public license"),
    ("vim", r"vim license"),
    ("w3c", r"w3c software(?: notice and)? license"),
    ("sspl-1", r"server side public license"),
    ("busl-1.1", r"business source license(?: version)?(?: v?1 1)?"),
    ("elastic-2", r"elastic license(?: version)? (?:v2|v?2 0|2)"),
    ("odbl", r"open database license|odbl(?: v?1 0)?"),
    ("odc-by", r"open data commons attribution license|odc by"),
    ("pddl", r"public domain dedication and license|pddl"),
    ("cc0", r"(?:creative commons )?cc0(?: v?1 0)?(?: universal)?|creative commons zero"),
    ("cc-by", r"cc by|creative commons attribution"),
    ("cc-by-sa", r"cc by sa|creative commons attribution share ?alike"),
    ("cc-by-nd", r"cc by nd|creative commons attribution no ?deriv(?:ative)?s"),
    ("cc-by-nc", r"cc by nc|creative commons attribution non ?commercial"),
    ("cc-by-nc-sa", r"cc by nc sa|creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", r"cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s"),
    ("openrail", r"(?:bigscience |creativeml )?open ?rail(?: m)?"),
    ("llama-community", r"llama (?:2|3|3 1) community"),
    ("proprietary", r"proprietary|commercial end user"),
)
#: (name of the frame, priority, confidence, wording around NAME).
FRAMES = (
    ("identifier", 4, 0.99, r"spdx license identifier (?:NAME)"),
    ("grant", 3, 0.95, r"(?:re)?(?:licen[cs]ed|leased|distributed|available|published|shared|provided) (?:to you )?"
                       r"(?:under|according to) (?:the )?(?:terms (?:and conditions )?of )?(?:the |a |an )?(?:NAME)(?: public)?(?: licen[cs]e)?"),
    ("terms", 3, 0.9, r"(?:under|subject to|governed by) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?(?:NAME)(?: licen[cs]e)"),
    ("name", 2, 0.8, r"(?:the )?(?:NAME) licen[cs]e(?: version \d+(?: \d+)?)?"),
    ("heading", 2, 0.7, r"licen[cs]e (?:NAME)"),
)
#: Rules without a name in them: (label, priority, confidence, keyword, regex).
NOTICES = (
    ("cc-by-nc", 2, 0.8, b"cc by nc", r"cc by nc(?: v?\d(?: \d)?)?"),
    ("cc-by-nc-sa", 2, 0.8, b"cc by nc sa", r"cc by nc sa(?: v?\d(?: \d)?)?"),
    ("cc-by-nc-nd", 2, 0.8, b"cc by nc nd", r"cc by nc nd(?: v?\d(?: \d)?)?"),
    ("cc-by-sa", 2, 0.8, b"cc by sa", r"cc by sa(?: v?\d(?: \d)?)?"),
    ("cc-by-nd", 2, 0.8, b"cc by nd", r"cc by nd(?: v?\d(?: \d)?)?"),
    ("cc-by", 1, 0.7, b"cc by", r"cc by(?: v?\d(?: \d)?)?"),
    ("cc0", 1, 0.7, b"cc0", r"cc0(?: 1 0)?"),
    ("gpl-2", 1, 0.7, b"gpl", r"(?:gnu )?gpl ?v?2(?: 0)?(?: or later)?"),
    ("gpl-3", 1, 0.7, b"gpl", r"(?:gnu )?gpl ?v?3(?: 0)?(?: or later)?"),
    ("all-rights-reserved", 1, 0.6, b"all rights reserved", r"all rights reserved"),
    ("copyright", 1, 0.4, b"copyright", r"copyright (?:c )?\d{4}"),
    ("public-domain", 1, 0.5, b"public domain", r"(?:in|into|to) the public domain"),
    ("mit", 3, 0.95, b"permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", 3, 0.9, b"permission to use", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", 3, 0.9, b"redistribution and use", r"redistribution and use in source and binary forms"),
    ("zlib", 3, 0.9, b"provided as is", r"this software is provided as is without any express or implied warranty"),
    # openings, headers and operative sentences of the licenses themselves
    ("apache-2", 3, 0.95, b"apache license", r"apache license version 2 0 january 2004"),
    ("apache-2", 3, 0.95, b"in compliance with the license", r"you may not use this (?:file|work|software) except in compliance with the license"),
    ("mit", 3, 0.9, b"substantial portions of the software", r"(?:the above )?copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("gpl-2", 3, 0.95, b"general public license", r"gnu general public license version 2 june 1991"),
    ("gpl-3", 3, 0.95, b"general public license", r"gnu general public license version 3 29 june 2007"),
    ("gpl", 3, 0.9, b"redistribute it and or modify it", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", 3, 0.9, b"redistribute it and or modify it", r"you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", 3, 0.9, b"redistribute it and or modify it", r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("lgpl-2.1", 3, 0.95, b"lesser general public license", r"gnu lesser general public license version 2 1 february 1999"),
    ("lgpl-3", 3, 0.95, b"lesser general public license", r"gnu lesser general public license version 3 29 june 2007"),
    ("agpl-3", 3, 0.95, b"affero general public license", r"gnu affero general public license version 3 19 november 2007"),
    ("gfdl", 3, 0.9, b"free documentation license", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2.0", 3, 0.95, b"source code form", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", 3, 0.95, b"mozilla public license", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("bsd-3-clause", 3, 0.95, b"neither the name", r"neither the name of (?:[a-z0-9]+ ){1,9}nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", 3, 0.95, b"advertising materials", r"all advertising materials mentioning features or use of this software must display"),
    ("bsd", 3, 0.85, b"binary form must reproduce", r"redistributions in binary form must reproduce the above copyright notice"),
    ("0bsd", 3, 0.8, b"with or without fee is hereby granted", r"(?:copy )?modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", 3, 0.9, b"copyright notice and this permission notice appear", r"provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", 3, 0.95, b"unencumbered software", r"this is free and unencumbered software released into the public domain"),
    ("zlib", 3, 0.9, b"altered source versions", r"altered source versions must be plainly marked as such and must not be misrepresented"),
    ("libpng", 3, 0.9, b"png reference library", r"png reference library license"),
    ("bsl-1.0", 3, 0.95, b"boost software license", r"boost software license version 1 0 august 17th 2003"),
    ("bsl-1.0", 3, 0.9, b"person or organization", r"free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("wtfpl", 3, 0.95, b"do what the fuck", r"you just do what the fuck you want to"),
    ("epl", 3, 0.9, b"accompanying materials", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cddl-1.0", 3, 0.9, b"common development and distribution", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("cpl-1.0", 3, 0.9, b"common public license", r"the accompanying program is provided under the terms of this common public license"),
    ("artistic-2", 3, 0.9, b"artistic license", r"the artistic license 2 0 copyright"),
    ("ofl-1.1", 3, 0.95, b"this font software", r"this font software is licensed under the sil open font license"),
    ("postgresql", 3, 0.9, b"without a written agreement", r"for any purpose without fee and without a written agreement is hereby granted"),
    ("psf-2", 3, 0.9, b"psf hereby grants", r"psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("openssl", 3, 0.9, b"openssl toolkit", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("php-3", 3, 0.9, b"php software", r"this product includes php software freely available from"),
    ("ms-pl", 3, 0.9, b"governs use of the accompanying", r"this license governs use of the accompanying software"),
    ("cc0", 3, 0.95, b"associated a work with this deed", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc0", 3, 0.9, b"waives", r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    ("cc-by", 2, 0.85, b"you must give appropriate credit", r"you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-by-sa", 3, 0.9, b"contributions under the same license", r"you must distribute your contributions under the same license as the original"),
    ("cc-by-nc", 3, 0.85, b"commercial purposes", r"you may not use the material for commercial purposes"),
    ("cc-by-nd", 3, 0.85, b"modified material", r"you may not distribute the modified material"),
    ("classpath-exception", 3, 0.95, b"as a special exception", r"as a special exception the copyright holders of this library give you permission to link this library with independent modules"),
    ("bison-exception", 3, 0.95, b"as a special exception", r"as a special exception you may create a larger work that contains part or all of the bison parser skeleton"),
    ("autoconf-exception", 3, 0.95, b"as a special exception", r"as a special exception (?:to the gnu general public license )?(?:the free software foundation gives unlimited permission to copy|if you distribute this file as part of a program that contains a configuration script)"),
    ("gcc-exception", 3, 0.95, b"gcc runtime library exception", r"gcc runtime library exception"),
    ("llvm-exception", 3, 0.95, b"llvm exception", r"llvm exceptions?"),
    ("proprietary", 3, 0.8, b"confidential and proprietary", r"(?:this (?:file|document|software) is )?confidential and proprietary"),
    ("proprietary", 3, 0.8, b"strictly prohibited", r"unauthorized copying of this (?:file|document|software)(?: via any medium)? is strictly prohibited"),
    ("public-domain", 2, 0.7, b"public domain", r"(?:has been|is hereby|is) (?:placed|released|dedicated) (?:in|into|to) the public domain"),
)


class Rule(NamedTuple):
    label: str
    priority: int
    confidence: float
    keywords: tuple[bytes, ...]
    regex: re.Pattern


BASE_PRIORITY = 9


def _rule(label: str, priority: int, confidence: float, keywords: tuple[bytes, ...], pattern: str) -> Rule:
    return Rule(label, priority, confidence, keywords, re.compile(b"(?<= )(?:" + pattern.encode() + b")(?= )"))


def rules() -> list[Rule]:
    """All rules, highest priority first; the keywords of a framed rule are the fixed words of its frame."""
    keywords = {"identifier": (b" spdx ",), "grant": (b" under ", b" according to "), "terms": (b" licen",),
                "name": (b" licen",), "heading": (b" licen",)}
    out = [_rule(label, p, c, keywords[frame], text.replace("NAME", name))
           for label, name in FAMILIES for frame, p, c, text in FRAMES]
    out += [_rule(label, p, c, (keyword,), text) for label, p, c, keyword, text in NOTICES]
    return sorted(out, key=lambda r: -r.priority)


_RULES = rules()
#: A name's own fixed start, tried before its frame: the second gate.
_NAMES = {label: re.compile(b"(?<= )(?:" + name.encode() + b")(?= )") for label, name in FAMILIES}
_KEYWORDS = tuple({k for r in _RULES for k in r.keywords})
#: ASCII: letters to lower case, digits kept, the rest to spaces; bytes of later characters are kept.
_WORDS = bytes(c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


class Detection(NamedTuple):
    label: str
    start: int
    end: int
    priority: int
    confidence: float


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


class Words:
    """Word numbers by place in a joined line, which starts with a space; the places are found once per line."""

    def __init__(self, line: bytes):
        self.line = line

    @cached_property
    def spaces(self) -> list[int]:
        return np.flatnonzero(np.frombuffer(self.line, np.uint8) == 32).tolist()

    def at(self, place: int) -> int:
        """Number of the word that starts at ``place``, or of the one after the last before it."""
        return bisect_left(self.spaces, place) - 1


def base_places(line: bytes, own: Words | None = None) -> list[Detection]:
    own, found = own or Words(line), []
    for phrase, label in BASE:
        n, needle, at = phrase.count(b" ") + 1, b" " + phrase + b" ", line.find(b" " + phrase + b" ")
        while at >= 0:
            word = own.at(at + 1)
            found.append(Detection(label, word, word + n, BASE_PRIORITY, 1.0))
            at = line.find(needle, at + 1)
    return found


def detections(line: bytes) -> list[Detection]:
    """Base places and what the rules add, after suppression."""
    own = Words(line)
    base = base_places(line, own)
    here = {k for k in _KEYWORDS if k in line}
    if not here:
        return base
    named: dict[str, bool] = {}
    found = list(base)
    for rule in _RULES:
        if here.isdisjoint(rule.keywords):
            continue
        if rule.label in _NAMES and rule.keywords[0][:1] == b" ":
            if rule.label not in named:
                named[rule.label] = _NAMES[rule.label].search(line) is not None
            if not named[rule.label]:
                continue
        for m in rule.regex.finditer(line):
            found.append(Detection(rule.label, own.at(m.start()), own.at(m.end()) + 1, rule.priority, rule.confidence))
    return suppress(found)


class _Spans:
    """Spans sorted by start, with the furthest end of any that starts no later."""

    def __init__(self, spans: list[Detection]):
        ordered = sorted((d.start, d.end) for d in spans)
        self.starts = [s for s, _ in ordered]
        self.ends = list(accumulate((e for _, e in ordered), max))

    def furthest(self, start: int, strictly: bool = False) -> int:
        """Furthest end of the spans that start at ``start`` or before it (``strictly``: before it)."""
        at = (bisect_left if strictly else bisect_right)(self.starts, start)
        return self.ends[at - 1] if at else -1


def suppress(found: list[Detection]) -> list[Detection]:
    """Drop a detection inside another one of higher priority, or of equal priority and more words.  (What contains it may be
    dropped as well: then something contains both.)  Base places stay.

    By priority, highest first; a detection asks for the furthest end among the spans that start no later than it, by
    bisection, so the work grows with n log n."""
    kept: list[Detection] = []
    higher: list[Detection] = []
    by_priority: dict[int, list[Detection]] = {}
    for d in set(found):
        by_priority.setdefault(d.priority, []).append(d)
    for priority in sorted(by_priority, reverse=True):
        own, above, equal = by_priority[priority], _Spans(higher), _Spans(by_priority[priority])
        for d in own:
            inside = above.furthest(d.start) >= d.end or equal.furthest(d.start, True) >= d.end or equal.furthest(d.start) > d.end
            if priority == BASE_PRIORITY or not inside:
                kept.append(d)
        higher += own
    return sorted(kept, key=lambda d: (d.start, d.end, d.label))


def scan_text(text: str | None) -> tuple[int, list[Detection]]:
    own = words(text)
    return len(own), detections(b" " + b" ".join(own) + b" ") if own else []


SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, evidence string")


def scan_licenses(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: word count, base places, labels, score, and ``evidence``: label:start:end of every
    surviving detection in word offsets."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch["_text"]:
                n, found = scan_text(t)
                base = [d.start for d in found if d.priority == BASE_PRIORITY]
                rows.append((n, len(base), min(base, default=None), max(base, default=None),
                             ",".join(sorted({d.label for d in found if d.priority == BASE_PRIORITY})),
                             ",".join(sorted({d.label for d in found})), max((d.confidence for d in found), default=0.0),
                             ",".join(f"{d.label}:{d.start}:{d.end}" for d in found)))
            out = pd.DataFrame(rows, columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                                              "score", "evidence"])
            for c in ("first_word", "last_word"):
                out[c] = out[c].astype("Int64")
            out.insert(0, key, batch["_key"].to_numpy())
            yield out

    src = df.select(df[key].alias("_key"), df[text].alias("_text"))
    return src.mapInPandas(run, f"`{key}` {df.schema[key].dataType.simpleString()}, {SCHEMA}")
