"""License scans: ordered signature rules over normalised words.

A text becomes its words, in lower case and joined by single spaces, so each rule is a regular
expression over words. A rule is tried only if the text has the rule's keyword, one of which is
in all that the rule can match. Detections are
resolved by priority: a detection inside the interval of an equal or higher one is suppressed.
Sentences that several licenses share count where no rule finds one of the others, and a family's
general label where none of its versions is found.

The base phrases report all their places and are never suppressed; the rules add labels.

Defined cases: null and empty texts have no words; repeated rows and null identifiers keep
their own row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_WORDS, row_batches, text_bytes

BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


class Rule(NamedTuple):
    label: str
    kind: str  # text, grant, notice, identifier, address, name
    priority: int
    confidence: float
    keyword: bytes
    pattern: re.Pattern
    others: frozenset[str]  # licenses whose text may hold the match as well


#: label: keyword, names, SPDX identifiers, addresses; all as regular expressions over words.
FAMILIES: dict[str, tuple[str, list[str], list[str], list[str]]] = {
    "mit": ("mit|expat", [r"mit(?: x11| expat)? licen[sc]e", "mit licen[sc]ed", r"expat licen[sc]e"], ["mit"], [r"opensource org licenses? mit"]),
    "mit-0": ("mit", ["mit no attribution(?: licen[sc]e)?"], ["mit 0"], [r"opensource org licenses? mit 0"]),
    "x11": ("x11", ["x11 licen[sc]e"], ["x11"], []),
    "apache-1.1": ("apache", [r"apache(?: software)? licen[sc]e(?: version)? v?1 1"], ["apache 1 1"], [r"apache org licenses? license 1 1"]),
    "apache-2": ("apache", [r"apache(?: software)? licen[sc]e(?: version)? v?2(?: 0)?", "apache v?2(?: 0)? licen[sc]e"], ["apache 2 0"], [r"apache org licenses? license 2 0"]),
    "bsd-2-clause": ("bsd|simplified", ["bsd 2 clause(?: licen[sc]e)?", "(?:simplified|freebsd) (?:bsd )?licen[sc]e", "2 clause bsd(?: licen[sc]e)?"], ["bsd 2 clause"], [r"opensource org licenses? bsd 2 clause"]),
    "bsd-3-clause": ("bsd", ["bsd 3 clause(?: licen[sc]e)?", "(?:new|modified|revised) bsd licen[sc]e", "3 clause bsd(?: licen[sc]e)?"], ["bsd 3 clause"], [r"opensource org licenses? bsd 3 clause"]),
    "bsd-4-clause": ("bsd", ["bsd 4 clause(?: licen[sc]e)?", "original bsd licen[sc]e"], ["bsd 4 clause"], []),
    "bsd": ("bsd", ["bsd(?: style)? licen[sc]e"], ["0bsd"], []),
    "isc": ("isc", ["isc licen[sc]e"], ["isc"], [r"opensource org licenses? isc"]),
    "gpl-1": ("gnu|gpl", [r"gnu (?:gpl|general public licen[sc]e)(?: version| v)? v?1(?: 0)?", "gpl ?v?1(?: 0)?"], ["gpl 1 0(?: only| or later)?"], []),
    "gpl-2": ("gpl|general public", [r"(?:gnu )?(?:gpl|general public licen[sc]e)(?: version| v)? v?2(?: 0)?", "gplv2"], ["gpl 2 0(?: only| or later)?"], [r"gnu org licenses (?:old licenses )?gpl 2 0"]),
    "gpl-3": ("gpl|general public", [r"(?:gnu )?(?:gpl|general public licen[sc]e)(?: version| v)? v?3(?: 0)?", "gplv3"], ["gpl 3 0(?: only| or later)?"], [r"gnu org licenses gpl 3 0"]),
    "gpl": ("gnu|gpl", ["gnu gpl", "gnu general public licen[sc]e"], [], [r"gnu org licenses gpl"]),
    "lgpl-2": ("lgpl|general public", [r"(?:gnu )?(?:lgpl|(?:library|lesser) general public licen[sc]e)(?: version| v)? v?2(?: 0)?", "lgplv2"], ["lgpl 2 0(?: only| or later)?"], []),
    "lgpl-2.1": ("lgpl|general public", [r"(?:gnu )?(?:lgpl|lesser general public licen[sc]e)(?: version| v)? v?2 1", "lgplv2 1"], ["lgpl 2 1(?: only| or later)?"], [r"gnu org licenses (?:old licenses )?lgpl 2 1"]),
    "lgpl-3": ("lgpl|general public", [r"(?:gnu )?(?:lgpl|lesser general public licen[sc]e)(?: version| v)? v?3(?: 0)?", "lgplv3"], ["lgpl 3 0(?: only| or later)?"], [r"gnu org licenses lgpl 3 0"]),
    "lgpl": ("gnu|lgpl", ["gnu (?:lgpl|(?:library|lesser) general public licen[sc]e)"], [], []),
    "agpl-3": ("gnu|agpl|affero", [r"(?:gnu )?(?:agpl|affero general public licen[sc]e)(?: version| v)?(?: v?3(?: 0)?)?", "agplv3"], ["agpl 3 0(?: only| or later)?"], [r"gnu org licenses agpl"]),
    "gfdl": ("gnu|gfdl", [r"gnu free documentation licen[sc]e(?: version 1 [1-3])?"], ["gfdl 1 [1-3](?: only| or later)?"], [r"gnu org licenses fdl"]),
    "mpl": ("mozilla", ["mozilla public licen[sc]e"], [], []),
    "mpl-1.1": ("mozilla|mpl", [r"(?:mozilla public licen[sc]e|mpl)(?: version| v)? v?1 1"], ["mpl 1 1"], [r"mozilla org mpl mpl 1 1"]),
    "mpl-2": ("mozilla|mpl", [r"(?:mozilla public licen[sc]e|mpl)(?: version| v)? v?2(?: 0)?"], ["mpl 2 0"], [r"mozilla org (?:en us )?mpl 2 0"]),
    "epl": ("eclipse", ["eclipse public licen[sc]e"], [], []),
    "epl-1": ("eclipse|epl", [r"(?:eclipse public licen[sc]e|epl)(?: version| v)? v?1(?: 0)?"], ["epl 1 0"], [r"eclipse org legal epl v10"]),
    "epl-2": ("eclipse|epl", [r"(?:eclipse public licen[sc]e|epl)(?: version| v)? v?2(?: 0)?"], ["epl 2 0"], [r"eclipse org legal epl (?:2 0|v20)"]),
    "cddl-1": ("cddl|development", [r"(?:common development and distribution licen[sc]e|cddl)(?: version| v)?(?: v?1(?: [01])?)?"], ["cddl 1 [01]"], [r"opensource org licenses? cddl"]),
    "cpl-1": ("common|cpl", [r"common public licen[sc]e(?: version)?(?: v?1(?: 0)?)?"], ["cpl 1 0"], []),
    "artistic-1": ("artistic", [r"artistic licen[sc]e(?: version| v)? v?1(?: 0)?"], ["artistic 1 0(?: perl)?"], []),
    "artistic-2": ("artistic", [r"artistic licen[sc]e(?: version| v)? v?2(?: 0)?"], ["artistic 2 0"], [r"opensource org licenses? artistic"]),
    "zlib": ("zlib", ["zlib(?: libpng)? licen[sc]e"], ["zlib"], [r"opensource org licenses? zlib"]),
    "boost-1": ("boost|bsl", [r"boost software licen[sc]e(?: version)?(?: v?1(?: 0)?)?"], ["bsl 1 0"], [r"boost org license 1 0"]),
    "busl-1.1": ("business|busl", [r"business source licen[sc]e(?: version)?(?: v?1 1)?"], ["busl 1 1"], []),
    "unlicense": ("unlicense", ["the unlicense"], ["unlicense"], ["unlicense org"]),
    "wtfpl": ("wtfpl|fuck", ["do what the fuck you want to public licen[sc]e"], ["wtfpl"], ["wtfpl net"]),
    "cc0-1": ("cc0", [r"cc0(?: 1 0)?(?: universal)?"], ["cc0 1 0"], [r"creativecommons org publicdomain zero 1 0"]),
    "cc-by": ("cc|creative", [r"cc by(?! n| s)(?: [1-4] [05])?", r"creative commons attribution(?! non| no| share)(?: [1-4] [05])?(?: international)?"], [r"cc by [1-4] [05]"], [r"creativecommons org licenses by [1-4] [05]"]),
    "cc-by-sa": ("cc|creative", [r"cc by sa(?: [1-4] [05])?", r"creative commons attribution share ?alike(?: [1-4] [05])?(?: international)?"], [r"cc by sa [1-4] [05]"], [r"creativecommons org licenses by sa"]),
    "cc-by-nd": ("cc|creative", [r"cc by nd(?: [1-4] [05])?", r"creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?(?: international)?"], [r"cc by nd [1-4] [05]"], [r"creativecommons org licenses by nd"]),
    "cc-by-nc": ("cc|creative", [r"cc by nc(?! sa| nd)(?: [1-4] [05])?", r"creative commons attribution non ?commercial(?! share| no)(?: [1-4] [05])?(?: international)?"], [r"cc by nc [1-4] [05]"], [r"creativecommons org licenses by nc(?! sa| nd)"]),
    "cc-by-nc-sa": ("cc|creative", [r"cc by nc sa(?: [1-4] [05])?", r"creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international)?"], [r"cc by nc sa [1-4] [05]"], [r"creativecommons org licenses by nc sa"]),
    "cc-by-nc-nd": ("cc|creative", [r"cc by nc nd(?: [1-4] [05])?", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?(?: international)?"], [r"cc by nc nd [1-4] [05]"], [r"creativecommons org licenses by nc nd"]),
    "odbl-1": ("odbl|database", [r"open (?:data commons open )?database licen[sc]e(?: v?1(?: 0)?)?"], ["odbl 1 0"], [r"opendatacommons org licenses odbl"]),
    "ofl-1.1": ("ofl|font", [r"sil open font licen[sc]e(?: version)?(?: v?1 1)?"], ["ofl 1 1"], [r"scripts sil org ofl"]),
    "psf-2": ("python|psf", [r"python software foundation licen[sc]e(?: version 2)?", "psf licen[sc]e"], ["(?:psf|python) 2 0"], []),
    "postgresql": ("postgresql", ["postgresql licen[sc]e"], ["postgresql"], [r"opensource org licenses? postgresql"]),
    "openssl": ("openssl", ["openssl licen[sc]e"], ["openssl"], []),
    "ms-pl": ("microsoft|ms", ["microsoft public licen[sc]e"], ["ms pl"], []),
    "ms-rl": ("microsoft|ms", ["microsoft reciprocal licen[sc]e"], ["ms rl"], []),
    "eupl-1.2": ("eupl|european", [r"european union public licen[sc]e(?: version| v)?(?: v?1 [0-2])?"], ["eupl 1 [0-2]"], []),
    "sspl-1": ("sspl|server", [r"server side public licen[sc]e(?: version| v)?(?: v?1)?"], ["sspl 1 0"], []),
    "elastic-2": ("elastic", [r"elastic licen[sc]e(?: version)?(?: v?2(?: 0)?)?"], ["elastic 2 0"], []),
    "upl-1": ("upl|universal", [r"universal permissive licen[sc]e(?: version| v)?(?: v?1 0)?"], ["upl 1 0"], []),
    "vim": ("vim", ["vim licen[sc]e"], ["vim"], []),
    "ncsa": ("ncsa|illinois", ["(?:university of illinois )?ncsa open source licen[sc]e"], ["ncsa"], []),
    "afl-3": ("academic|afl", [r"academic free licen[sc]e(?: version| v)?(?: v?3(?: 0)?)?"], ["afl 3 0"], []),
    "qpl-1": ("qpl|qt|q public", ["q public licen[sc]e(?: version)?(?: v?1(?: 0)?)?"], ["qpl 1 0"], []),
    "public-domain": ("public domain", [r"(?:released|placed|dedicated) (?:in|into|to) the public domain"], [], []),
    "proprietary": ("reserved|proprietary|confidential", [r"proprietary and confidential", "all rights reserved unauthorized copying"], [], []),
}

#: Sentences of license texts.
SENTENCES: list[tuple[str, str, str]] = [
    ("mit", "to deal in the software", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software"),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd-3-clause", "endorse", r"neither the names? of [^\n]{1,80}? nor the names of its contributors may be used to endorse"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2", "in compliance with", r"you may not use this file except in compliance with the license"),
    ("gpl", "free software", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl-2", "free software", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation(?: either)? version 2 of the license"),
    ("gpl-3", "free software", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation(?: either)? version 3 of the license"),
    ("lgpl", "free software", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:library|lesser) general public license"),
    ("lgpl-2", "free software", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:library|lesser) general public license as published by the free software foundation(?: either)? version 2 of the license"),
    ("lgpl-2.1", "free software", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:library|lesser) general public license as published by the free software foundation(?: either)? version 2 1 of the license"),
    ("lgpl-3", "free software", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:library|lesser) general public license as published by the free software foundation(?: either)? version 3 of the license"),
    ("agpl-3", "affero", r"under the terms of the gnu affero general public license"),
    ("mpl-2", "source code form", r"this source code form is subject to the terms of the mozilla public license"),
    ("epl-1", "accompanying materials", r"this program and the accompanying materials are made available under the terms of the eclipse public license(?: version| v)? v?1(?: 0)?"),
    ("epl-2", "accompanying materials", r"this program and the accompanying materials are made available under the terms of the eclipse public license(?: version| v)? v?2(?: 0)?"),
    ("epl", "accompanying materials", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("zlib", "as is", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("boost-1", "boost", r"distributed under the boost software license"),
    ("boost-1", "person or organization", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("cc0-1", "waived", r"to the extent possible under law [^\n]{1,80}? has waived all copyright"),
    ("ofl-1.1", "font software", r"this font software is licensed under the sil open font license"),
    ("mit", "substantial portions", r"this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-0", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software [^\n]{1,400}? to permit persons to whom the software is furnished to do so the software is provided"),
    ("x11", "consortium", r"except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("isc", "isc", r"the above copyright notice and this permission notice appear in all copies the software is provided as is and isc disclaims"),
    ("isc", "author disclaims", r"the software is provided as is and the author disclaims all warranties"),
    ("bsd-3-clause", "endorse or promote", r"may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("apache-2", "limitations under", r"see the license for the specific language governing permissions and limitations under the license"),
    ("apache-2", "copyright license", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("apache-1.1", "apache software foundation", r"this product includes software developed by the apache software foundation"),
    ("gpl", "gnu", r"you should have received a copy of the gnu general public license along with this program"),
    ("gpl-3", "copyleft", r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("lgpl", "gnu", r"you should have received a copy of the gnu (?:library|lesser) general public license along with this library"),
    ("lgpl", "in isolation", r"such a work in isolation is not a derivative work of the library"),
    ("agpl-3", "network server", r"specifically designed to ensure cooperation with the community in the case of network server software"),
    ("gfdl", "invariant sections", r"with no invariant sections no front cover texts and no back cover texts"),
    ("mpl-2", "mpl", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-1.1", "mozilla", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl", "eclipse", r"the accompanying program is provided under the terms of this eclipse public license"),
    ("cddl-1", "common development", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("cpl-1", "common public", r"the accompanying program is provided under the terms of this common public license"),
    ("artistic-2", "free software package", r"this license establishes the terms under which a given free software package may be copied modified distributed"),
    ("zlib", "altered source", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", "origin of this software", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("boost-1", "executable object code", r"unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor"),
    ("unlicense", "anyone is free", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", "fuck", r"you just do what the fuck you want to"),
    ("cc0-1", "dedicated to the public domain", r"has dedicated to the public domain to the extent possible under law"),
    ("cc-by-sa", "share alike", r"you may distribute your adaptation only under the same share alike license"),
    ("cc-by", "appropriate credit", r"you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-by-nc", "commercial purposes", r"you may not use the material for commercial purposes"),
    ("cc-by-nd", "transform or build", r"if you remix transform or build upon the material you may not distribute the modified material"),
    ("odbl-1", "database", r"this database is made available under the open database license"),
    ("ofl-1.1", "reserved font name", r"with reserved font name"),
    ("psf-2", "psf", r"psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("openssl", "openssl", r"this product includes software developed by the openssl project"),
    ("postgresql", "without fee", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
    ("busl-1.1", "change date", r"on the change date or the fourth anniversary of the first publicly available distribution"),
    ("sspl-1", "service source code", r"you must make the service source code available via network download to everyone at no charge"),
    ("elastic-2", "managed service", r"you may not provide the software to third parties as a hosted or managed service"),
    ("eupl-1.2", "eupl", r"licensed under the eupl"),
    ("ncsa", "with the software without restriction", r"to deal with the software without restriction including without limitation the rights to use"),
    ("public-domain", "public domain", r"this (?:file|work|code|software) is in the public domain"),
    ("proprietary", "unauthorized", r"unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", "confidential", r"this (?:document|file) contains confidential (?:and proprietary )?information"),
]

#: Licenses that the disclaimers of the permissive ones stand in.
_PERMISSIVE = {"mit", "mit-0", "x11", "isc", "ncsa", "unlicense", "boost-1", "zlib"}
_BSD = {"bsd-2-clause", "bsd-3-clause", "bsd-4-clause", "apache-1.1", "openssl", "ncsa"}
_GPL = {"gpl-1", "gpl-2", "gpl-3", "agpl-3", "lgpl", "lgpl-2", "lgpl-2.1", "lgpl-3"}
#: Sentences of several licenses: label, confidence, others, keyword, pattern. The label counts only where no rule finds one of the others.
SHARED: list[tuple[str, float, set[str], str, str]] = [
    ("mit", 0.9, {"mit-0", "ncsa"}, "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("permissive", 0.5, _PERMISSIVE, "noninfringement", r"merchantability fitness for a particular purpose and noninfringement"),
    ("permissive", 0.5, _PERMISSIVE, "warranty of any kind", r"the software is provided as is without warranty of any kind express or implied"),
    ("bsd", 1.0, _BSD, "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", 1.0, _BSD, "above copyright notice", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", 1.0, _BSD, "above copyright notice", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("gpl", 1.0, _GPL, "merchantability", r"this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability"),
    ("gpl", 1.0, _GPL, "freedom to share", r"the licenses for most software are designed to take away your freedom to share and change it"),
]

#: A family's general label goes where one of its versions is found.
GENERAL = {
    "gpl": {"gpl-1", "gpl-2", "gpl-3"}, "lgpl": {"lgpl-2", "lgpl-2.1", "lgpl-3"}, "bsd": {"bsd-2-clause", "bsd-3-clause", "bsd-4-clause"},
    "mpl": {"mpl-1.1", "mpl-2"}, "epl": {"epl-1", "epl-2"},
}


def build_rules() -> list[Rule]:
    """All rules, highest priority first: for each family grants, notices, identifiers, addresses and bare names."""

    rules: list[Rule] = []

    def rule(label: str, kind: str, priority: int, confidence: float, keyword: str, pattern: str, others: frozenset[str] = frozenset()) -> None:
        compiled = re.compile(f"(?<= )(?:{pattern})(?= )".encode())
        rules.append(Rule(label, kind, priority, confidence, keyword.encode(), compiled, others))

    for label, keyword, sentence in SENTENCES:
        rule(label, "text", 60, 1.0, keyword, sentence)
    for label, confidence, others, keyword, sentence in SHARED:
        rule(label, "shared", 60, confidence, keyword, sentence, frozenset(others))
    for label, (keyword, names, ids, addresses) in FAMILIES.items():
        # of two names at the same place the longer one is the more specific
        for name in names:
            rule(label, "grant", 50, 0.95, keyword, rf"(?:(?:dual )?licen[sc]ed|released|distributed|available|published|provided) (?:under|by|with)(?: the)?(?: terms of)?(?: the)? {name}")
            rule(label, "notice", 40, 0.85, keyword, rf"(?:licen[sc]es?|licencia|lizenz|licence|terms)(?: of| is| are| under| type| name)*(?: the)? {name}")
            rule(label, "name", 10, 0.6, keyword, name)
        for i in ids:
            rule(label, "identifier", 45, 1.0, "spdx", f"spdx license identifier {i}")
            rule(label, "grant", 44, 0.9, keyword, f"(?:dual )?licen[sc]ed under(?: the)?(?: terms of)?(?: the)? {i}")
            rule(label, "field", 30, 0.8, keyword, f"(?:license|licence) {i}")
        for a in addresses:
            rule(label, "address", 35, 0.9, a.split()[0].replace("\\", ""), f"(?:https? )?(?:www )?{a}(?: html| txt| php)?")
    rules.sort(key=lambda r: -r.priority)
    return rules


class Detection(NamedTuple):
    start: int
    end: int
    priority: int
    confidence: float
    label: str
    kind: str


def normalised(text: bytes) -> tuple[bytes, int]:
    """The words with single spaces between and around them, and their number."""
    ws = text.translate(ALNUM_WORDS).split()
    return b" " + b" ".join(ws) + b" ", len(ws)


def base_places(norm: bytes) -> list[tuple[int, str]]:
    """(place in the normalised text, label) of every base phrase."""
    found = []
    for phrase, label in BASE.items():
        needle, at = f" {phrase} ".encode(), -1
        while (at := norm.find(needle, at + 1)) >= 0:
            found.append((at, label))
    return sorted(found)


_ID = "|".join(i for _, _, ids, _ in FAMILIES.values() for i in ids)
_LABEL_OF_ID = [(re.compile(i.encode()), label) for label, (_, _, ids, _) in FAMILIES.items() for i in ids]
_EXPRESSION = re.compile(f"(?<= )spdx license identifier (?:{_ID})(?: (?:with [^\n]{{1,60}}? )?(?:or|and) (?:{_ID}))+(?= )".encode())
_OPERAND = re.compile(f"(?<= )(?:or|and) ({_ID})(?= )".encode())


def operands(norm: bytes) -> list[Detection]:
    """The identifiers behind the first one of each SPDX expression; the first has a rule."""
    found = []
    for e in _EXPRESSION.finditer(norm):
        for m in _OPERAND.finditer(norm, e.start(), e.end() + 1):
            label = next(label for i, label in _LABEL_OF_ID if i.fullmatch(m[1]))
            found.append(Detection(m.start(1), m.end(1), 45, 1.0, label, "identifier"))
    return found


def detect(norm: bytes, rules: list[Rule]) -> list[Detection]:
    """Detections that no equal or higher one contains, by place. Sentences of several licenses and labels of whole
    families count where nothing more specific is found."""
    found: list[Detection] = operands(norm) if b"spdx" in norm else []
    doubtful: list[tuple[Detection, frozenset[str]]] = []
    has: dict[bytes, bool] = {}
    for r in rules:
        if r.keyword not in has:
            has[r.keyword] = any(k in norm for k in r.keyword.split(b"|"))
        if has[r.keyword]:
            places = [Detection(m.start(), m.end(), r.priority, r.confidence, r.label, r.kind) for m in r.pattern.finditer(norm)]
            if r.others:
                doubtful += [(d, r.others) for d in places]
            else:
                found += places
    labels = {d.label for d in found} | {d.label for d, _ in doubtful}
    found += [d for d, others in doubtful if not others & labels]
    return outermost([d for d in found if not GENERAL.get(d.label, set()) & labels])


def outermost(found: list[Detection]) -> list[Detection]:
    """The detections that no equal or higher one contains, by place; of equal priority the longer
    counts, then the earlier. One pass by rank over a tree of the largest end up to each start."""
    starts = {at: i for i, at in enumerate(sorted({d.start for d in found}), 1)}
    reach = [0] * (len(starts) + 1)
    kept: list[Detection] = []
    for d in sorted(found, key=lambda d: (-d.priority, d.start - d.end, d.start, d.label)):
        i = own = starts[d.start]
        end = 0
        while i:
            end = max(end, reach[i])
            i &= i - 1
        if end >= d.end:
            continue
        kept.append(d)
        while own < len(reach):
            reach[own] = max(reach[own], d.end)
            own += own & -own
    return sorted(kept)


SCANNED = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<label:string,kind:string,first_word:long,words:long,confidence:double>>"


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row for each document: base places, labels, a score (the surest detection) and all detections."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = build_rules()
        kind = pa.list_(pa.struct([("label", pa.string()), ("kind", pa.string()), ("first_word", pa.int64()), ("words", pa.int64()), ("confidence", pa.float64())]))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), kind)
        for b in row_batches(batches):
            out: list[tuple] = []
            for doc, text in zip(*(c.to_pylist() for c in b.columns)):
                norm, n = normalised(text_bytes(text))
                base = base_places(norm)
                more = detect(norm, rules)
                # spaces stand before each word and behind the last, so word k begins behind space k
                spaces = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32) if base or more else ()
                word = lambda at: int(np.searchsorted(spaces, at))
                labels = {x for _, x in base}
                every = sorted(labels | {d.label for d in more})
                score = max([1.0 if base else 0.0, *(d.confidence for d in more)])
                spans = [(d.label, d.kind, word(d.start) - 1, word(d.end) - word(d.start) + 1, d.confidence) for d in more]
                out.append((
                    doc, n, len(base), word(base[0][0]) if base else None, word(base[-1][0]) if base else None,
                    ",".join(sorted(labels)), ",".join(every), score,
                    [dict(zip(("label", "kind", "first_word", "words", "confidence"), s)) for s in spans],
                ))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, SCANNED)
