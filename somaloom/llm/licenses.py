"""License scan: ordered signature rules behind a keyword prefilter.

One automaton finds which keywords stand in a text; only rules with a keyword there are tried. A rule's
keywords are read off its pattern: every match holds one of them, once gaps are folded to one blank. Each match
is a detection with the rule's label, priority and score. Detections are taken in order of priority,
then length, then place; one that lies inside an accepted detection is suppressed, so a bare name inside
a full notice, or a family name inside a versioned one, adds no label of its own.

Four base phrases are searched in every text by word position, whatever stands between the words; their
labels always stay.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows are scanned
each; an empty table gives no rows; other columns are ignored; texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from re import _constants, _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, slices, tidy
from .words import ALNUM, span_hash, split

BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
BASE_SCORE = 0.6


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    priority: int
    score: float
    pattern: re.Pattern


#: label | title | address | SPDX ids. Titles and addresses are patterns over lower-case text; a
#: space matches any run of white space, quotes and comment marks.
FAMILIES = r"""
agpl-3.0 | (gnu )?affero general public licen[sc]e,? (v|version )?3(\.0)? | gnu\.org/licenses/agpl-3 | agpl-3\.0(-only|-or-later)?
agpl | (gnu )?affero general public licen[sc]e | gnu\.org/licenses/agpl | agpl(-1\.0)?
lgpl-3.0 | (gnu )?lesser general public licen[sc]e,? (as published by the free software foundation, either )?(v|version )3(\.0)? | gnu\.org/licenses/lgpl-3 | lgpl-3\.0(-only|-or-later)?
lgpl-2.1 | (gnu )?lesser general public licen[sc]e,? (as published by the free software foundation; either )?(v|version )2\.1 | gnu\.org/licenses/(old-licenses/)?lgpl-2\.1 | lgpl-2\.1(-only|-or-later)?
lgpl-2.0 | (gnu )?library general public licen[sc]e | gnu\.org/licenses/old-licenses/lgpl-2\.0 | lgpl-2\.0(-only|-or-later)?
lgpl | (gnu )?lesser general public licen[sc]e | gnu\.org/licenses/lgpl | lgpl
gpl-3.0 | (gnu )?general public licen[sc]e,? (as published by the free software foundation,? either )?(v|version )3(\.0)? | gnu\.org/licenses/gpl-3 | gpl-3\.0(-only|-or-later)?
gpl-2.0 | (gnu )?general public licen[sc]e,? (as published by the free software foundation[;,]? either )?(v|version )2(\.0)? | gnu\.org/licenses/(old-licenses/)?gpl-2 | gpl-2\.0(-only|-or-later)?
gpl-1.0 | (gnu )?general public licen[sc]e,? (v|version )1(\.0)? | gnu\.org/licenses/old-licenses/gpl-1 | gpl-1\.0(-only|-or-later)?
gpl | gnu general public licen[sc]e | gnu\.org/licenses/gpl | gpl
gfdl-1.3 | (gnu )?free documentation licen[sc]e,? (v|version )1\.3 | gnu\.org/licenses/fdl-1\.3 | gfdl-1\.3(-only|-or-later)?
gfdl-1.2 | (gnu )?free documentation licen[sc]e,? (v|version )1\.2 | gnu\.org/licenses/old-licenses/fdl-1\.2 | gfdl-1\.2(-only|-or-later)?
gfdl | (gnu )?free documentation licen[sc]e | gnu\.org/licenses/fdl | gfdl-1\.1(-only|-or-later)?
apache-2.0 | apache (software )?licen[sc]e,? ?\(?(v|version )?2(\.0)?\)? | apache\.org/licenses/license-2\.0 | apache-2\.0
apache-1.1 | apache (software )?licen[sc]e,? (v|version )?1\.1 | apache\.org/licenses/license-1\.1 | apache-1\.1
apache-1.0 | apache (software )?licen[sc]e,? (v|version )?1\.0 | apache\.org/licenses/license-1\.0 | apache-1\.0
mit-0 | mit no attribution( licen[sc]e)? | github\.com/aws/mit-0 | mit-0
mit | (the )?(mit|expat|x11) licen[sc]e(?! agreement) | opensource\.org/licen[sc]es?/mit | (mit|x11)
bsd-4-clause | (original|4[- ]clause|four[- ]clause) bsd( licen[sc]e)? | spdx\.org/licenses/bsd-4-clause | bsd-4-clause(-uc)?
bsd-3-clause | (new|modified|revised|3[- ]clause|three[- ]clause) bsd( licen[sc]e)? | opensource\.org/licen[sc]es?/bsd-3-clause | bsd-3-clause(-clear|-attribution|-lbnl)?
bsd-2-clause | (simplified|freebsd|2[- ]clause|two[- ]clause) (bsd( licen[sc]e)?|licen[sc]e) | opensource\.org/licen[sc]es?/bsd-2-clause | bsd-2-clause(-patent|-views)?
0bsd | (zero[- ]clause|0[- ]clause|free public) (bsd( licen[sc]e)?|licen[sc]e 1\.0\.0) | opensource\.org/licen[sc]es?/0bsd | 0bsd
bsd | bsd([- ]style)? licen[sc]e | opensource\.org/licen[sc]es?/bsd-license | bsd-1-clause
isc | isc licen[sc]e | opensource\.org/licen[sc]es?/isc | isc
mpl-2.0 | mozilla public licen[sc]e,? (v|version )?2(\.0)? | mozilla\.org/(en-us/)?mpl/2\.0 | mpl-2\.0(-no-copyleft-exception)?
mpl-1.1 | mozilla public licen[sc]e,? (v|version )?1\.1 | mozilla\.org/(en-us/)?mpl/1\.1 | mpl-1\.1
mpl-1.0 | mozilla public licen[sc]e,? (v|version )?1\.0 | mozilla\.org/(en-us/)?mpl/1\.0 | mpl-1\.0
mpl | mozilla public licen[sc]e | mozilla\.org/(en-us/)?mpl/? | mpl
epl-2.0 | eclipse public licen[sc]e,? (- )?(v|version )?2(\.0)? | eclipse\.org/(legal|org/documents)/epl-(2\.0|v20) | epl-2\.0
epl-1.0 | eclipse public licen[sc]e,? (- )?(v|version )?1(\.0)? | eclipse\.org/(legal|org/documents)/epl-v10 | epl-1\.0
edl-1.0 | eclipse distribution licen[sc]e | eclipse\.org/org/documents/edl-v10 | edl-1\.0
cpl-1.0 | common public licen[sc]e | opensource\.org/licen[sc]es?/cpl1\.0 | cpl-1\.0
ipl-1.0 | ibm public licen[sc]e | opensource\.org/licen[sc]es?/ibmpl | ipl-1\.0
cddl-1.1 | common development and distribution licen[sc]e,? (\(cddl\) )?(v|version )?1\.1 | opensource\.org/licen[sc]es?/cddl-1\.1 | cddl-1\.1
cddl-1.0 | common development and distribution licen[sc]e | opensource\.org/licen[sc]es?/cddl(-1\.0|1) | cddl-1\.0
eupl-1.2 | european union public licen[sc]e,? (v|version )?\.? ?1\.2 | joinup\.ec\.europa\.eu/.{0,40}eupl-1\.2 | eupl-1\.2
eupl-1.1 | european union public licen[sc]e | joinup\.ec\.europa\.eu/.{0,40}eupl | eupl-1\.[01]
bsl-1.0 | boost software licen[sc]e | boost\.org/license_1_0 | bsl-1\.0
zlib | zlib( licen[sc]e|/libpng licen[sc]e) | opensource\.org/licen[sc]es?/zlib | zlib(-acknowledgement)?
libpng | (png reference library|libpng) licen[sc]e | libpng\.org/pub/png/src/libpng-license | libpng(-2\.0)?
unlicense | (the )?unlicense | unlicense\.org | unlicense
wtfpl | do what the f[a-z*]{3} you want to public licen[sc]e | wtfpl\.net | wtfpl
artistic-2.0 | artistic licen[sc]e,? (v|version )?2(\.0)? | opensource\.org/licen[sc]es?/artistic-(license-)?2\.0 | artistic-2\.0
artistic-1.0 | (clarified )?artistic licen[sc]e | opensource\.org/licen[sc]es?/artistic-(license-)?1\.0 | (artistic-1\.0(-perl|-cl8)?|clartistic)
afl-3.0 | academic free licen[sc]e | opensource\.org/licen[sc]es?/afl-3\.0 | afl-[123]\.[012]
osl-3.0 | open software licen[sc]e | opensource\.org/licen[sc]es?/osl-3\.0 | osl-[123]\.[01]
ofl-1.1 | (sil )?open font licen[sc]e | scripts\.sil\.org/ofl | ofl-1\.[01](-rfn|-no-rfn)?
ms-pl | microsoft public licen[sc]e | opensource\.org/licen[sc]es?/ms-pl | ms-pl
ms-rl | microsoft reciprocal licen[sc]e | opensource\.org/licen[sc]es?/ms-rl | ms-rl
ncsa | (university of illinois/ncsa|uiuc/ncsa|ncsa/university of illinois) open source licen[sc]e | opensource\.org/licen[sc]es?/(uoi-)?ncsa | ncsa
python-2.0 | (python software foundation|psf|python) licen[sc]e( agreement)? | docs\.python\.org/.{0,10}license | (python-2\.0(\.1)?|psf-2\.0)
ruby | (the )?ruby('s)? licen[sc]e | ruby-lang\.org/.{0,12}license | ruby
php-3.01 | (the )?php licen[sc]e | php\.net/license | php-3\.0(1)?
w3c | w3c software (notice and )?(and document )?licen[sc]e | w3\.org/consortium/legal | w3c(-20150513|-19980720)?
postgresql | postgresql licen[sc]e | opensource\.org/licen[sc]es?/postgresql | postgresql
openssl | openssl licen[sc]e | openssl\.org/source/license | openssl
sleepycat | sleepycat licen[sc]e | opensource\.org/licen[sc]es?/sleepycat | sleepycat
upl-1.0 | universal permissive licen[sc]e | oss\.oracle\.com/licenses/upl | upl-1\.0
vim | vim licen[sc]e | vimdoc\.sourceforge\.net/.{0,20}license | vim
zpl-2.1 | zope public licen[sc]e | zope\.org/.{0,20}zpl | zpl-[12]\.[01]
mulan-2.0 | mulan (permissive software|psl) licen[sc]e | license\.coscl\.org\.cn/mulanpsl2 | mulanpsl-[12]\.0
sspl-1.0 | server side public licen[sc]e | mongodb\.com/licensing/server-side-public-license | sspl-1\.0
busl-1.1 | business source licen[sc]e | mariadb\.com/bsl11 | busl-1\.1
elastic-2.0 | elastic licen[sc]e,? (v|version )?2(\.0)? | elastic\.co/licensing/elastic-license | elastic-2\.0
polyform | polyform (noncommercial|small business|shield|strict|internal use|perimeter) licen[sc]e | polyformproject\.org/licenses | polyform-(noncommercial|small-business)-1\.0\.0
ecl-2.0 | educational community licen[sc]e | opensource\.org/licen[sc]es?/ecl-2\.0 | ecl-[12]\.0
rpl-1.5 | reciprocal public licen[sc]e | opensource\.org/licen[sc]es?/rpl-1\.5 | rpl-1\.[15]
qpl-1.0 | q public licen[sc]e | opensource\.org/licen[sc]es?/qpl-1\.0 | qpl-1\.0
cecill-2.1 | cecill( free software)? licen[sc]e( agreement)? | cecill\.info/licences | cecill-([12]\.[01]|b|c)
odbl-1.0 | (odc )?open database licen[sc]e | opendatacommons\.org/licenses/odbl | odbl-1\.0
odc-by | open data commons attribution licen[sc]e | opendatacommons\.org/licenses/by | odc-by-1\.0
pddl-1.0 | (odc )?public domain dedication and licen[sc]e | opendatacommons\.org/licenses/pddl | pddl-1\.0
ogl-uk | open government licen[sc]e | nationalarchives\.gov\.uk/doc/open-government-licence | ogl-uk-[123]\.0
cc0-1.0 | cc0( 1\.0)?( universal)?( public domain dedication)? | creativecommons\.org/publicdomain/zero | cc0-1\.0
cc-by-nc-nd | cc[- ]by-nc-nd([- ][1-4]\.0)? | creativecommons\.org/licenses/by-nc-nd | cc-by-nc-nd-[1-4]\.[05]
cc-by-nc-sa | cc[- ]by-nc-sa([- ][1-4]\.0)? | creativecommons\.org/licenses/by-nc-sa | cc-by-nc-sa-[1-4]\.[05]
cc-by-nc | cc[- ]by-nc([- ][1-4]\.0)? | creativecommons\.org/licenses/by-nc/ | cc-by-nc-[1-4]\.[05]
cc-by-nd | cc[- ]by-nd([- ][1-4]\.0)? | creativecommons\.org/licenses/by-nd | cc-by-nd-[1-4]\.[05]
cc-by-sa | cc[- ]by-sa([- ][1-4]\.0)? | creativecommons\.org/licenses/by-sa | cc-by-sa-[1-4]\.[05]
cc-by-4.0 | cc[- ]by[- ]4\.0 | creativecommons\.org/licenses/by/4\.0 | cc-by-4\.0
cc-by-3.0 | cc[- ]by[- ]3\.0 | creativecommons\.org/licenses/by/3\.0 | cc-by-3\.0
cc-by | cc[- ]by | creativecommons\.org/licenses/by/ | cc-by-[12]\.[05]
"""

#: label | pattern: sentences that stand in a license's own text or usual notice
SENTENCES = r"""
apache-2.0 | licensed under the apache licen[sc]e,? version 2\.0( \(the .?licen[sc]e.?\))?
apache-2.0 | distributed under the licen[sc]e is distributed on an .?as is.? basis,? without warranties or conditions of any kind,? either express or implied
mit | permission is hereby granted,? free of charge,? to any person obtaining a copy of this software and associated documentation files
mit | the software is provided .?as is.?,? without warranty of any kind,? express or implied,? including but not limited to the warranties of merchantability
mit | (released|licensed|distributed|available) under the (terms of the )?mit licen[sc]e
isc | permission to use,? copy,? modify,? and(/or)? distribute this software for any purpose with or without fee is hereby granted
bsd-3-clause | neither the name of .{1,80} nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | all advertising materials mentioning features or use of this software must display
bsd-2-clause | redistribution and use in source and binary forms,? with or without modification,? are permitted provided that
gpl-3.0 | (either )?version 3 of the licen[sc]e,? or \(?at your option\)? any later version
gpl-2.0 | (either )?version 2 of the licen[sc]e,? or \(?at your option\)? any later version
gpl | this program is free software[:;,]? you can redistribute it and/or modify it under the terms of the gnu general public licen[sc]e
gpl | (released|licensed|distributed|available) under the (terms of the )?(gnu )?general public licen[sc]e
gpl | you should have received a copy of the gnu general public licen[sc]e
lgpl | you should have received a copy of the gnu lesser general public licen[sc]e
agpl | you should have received a copy of the gnu affero general public licen[sc]e
mpl-2.0 | this source code form is subject to the terms of the mozilla public licen[sc]e,? v\. ?2\.0
mpl-1.1 | the contents of this file are subject to the mozilla public licen[sc]e version 1\.1
epl-2.0 | this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e
cc-by-sa | creative commons attribution[- ]share ?-?alike
cc-by-nc | creative commons attribution[- ]non ?-?commercial(?![- ](share|no))
cc-by-nc-sa | creative commons attribution[- ]non ?-?commercial[- ]share ?-?alike
cc-by-nc-nd | creative commons attribution[- ]non ?-?commercial[- ]no ?-?deriv
cc-by-nd | creative commons attribution[- ]no ?-?deriv
cc-by | creative commons attribution(?![- ](share|non|no ?-?deriv))
cc0-1.0 | creative commons (zero|cc0)
unlicense | this is free and unencumbered software released into the public domain
zlib | the origin of this software must not be misrepresented
bsl-1.0 | distributed under the boost software licen[sc]e
wtfpl | everyone is permitted to copy and distribute verbatim or modified copies of this licen[sc]e document.{0,40}do what the
ofl-1.1 | this font software is licensed under the sil open font licen[sc]e
artistic-2.0 | you may use and distribute it under the terms of the artistic licen[sc]e
cddl-1.0 | subject to the terms of the common development and distribution licen[sc]e
public-domain | (dedicated|released|placed) (in)?to the public domain
all-rights-reserved | copyright .{0,80}all rights reserved
proprietary | (confidential and proprietary|proprietary and confidential|unauthorized copying of this file)
"""

_GAP = r"""[\s"'*#/]+"""


def _compiled(pattern: str) -> re.Pattern:
    """A pattern that starts and ends at a word's edge; its spaces match any gap, ``[- ]`` also a hyphen."""
    pattern = pattern.replace("[- ]", "\0").replace(" ?", "\1").replace(" ", _GAP).replace("\1", f"(?:{_GAP})?").replace("\0", f"(?:-|{_GAP})")
    return re.compile(rf"(?<![a-z0-9])(?:{pattern})(?![a-z0-9])", re.S)


@cache
def rules() -> tuple[Rule, ...]:
    """Every rule, in order: identifiers, license sentences, notices, titles, addresses, bare ids."""
    out = []
    for line in FAMILIES.strip().splitlines():
        label, title, address, ids = (part.strip() for part in line.split(" | "))
        versioned = 1 if re.search(r"\d", label) else 0
        out += [
            Rule(f"{label}/spdx", label, 90 + versioned, 1.0, _compiled(rf"spdx-license-identifier:\s*\(?{ids}")),
            Rule(f"{label}/notice", label, 70 + versioned, 0.95, _compiled(rf"(licen[sc]ed|released|distributed|available|provided|published) under (the )?(terms of )?(the )?{title}")),
            Rule(f"{label}/address", label, 60 + versioned, 0.9, re.compile(rf"(?<![a-z0-9])(?:https?://)?(?:www\.)?{address}", re.S)),
            Rule(f"{label}/title", label, 50 + versioned, 0.8, _compiled(title)),
            Rule(f"{label}/field", label, 40 + versioned, 0.85, _compiled(rf"licen[sc]e\W{{0,3}}[:=]\s*\W?{ids}")),
        ]
    for k, line in enumerate(SENTENCES.strip().splitlines()):
        label, pattern = (part.strip() for part in line.split(" | "))
        family = label in ("gpl", "lgpl", "agpl")  # a notice that names the version goes before these
        out.append(Rule(f"{label}/sentence-{k}", label, 65 if family else 80, 0.95, _compiled(pattern)))
    return tuple(sorted(out, key=lambda r: (-r.priority, r.name)))


MAX_FORMS = 64


def _fold(text: str) -> str:
    """The text with every gap as one blank."""
    for mark in "\"'*#/":
        text = text.replace(mark, " ")
    return f" {' '.join(text.split())} "


def _gap(op, value) -> bool:
    """Is this part of a pattern ``_GAP``?"""
    return op is _constants.MAX_REPEAT and value[0] == 1 and list(value[2]) == _GAP_ITEM


_GAP_ITEM = list(list(_parser.parse(_GAP))[0][1][2])


def _forms(op, value) -> set[str] | None:
    """All texts that a part of a pattern matches, gaps as one blank; None if they are not few."""
    if _gap(op, value):
        return {" "}
    if op is _constants.LITERAL:
        return {chr(value)}
    if op in (_constants.ASSERT, _constants.ASSERT_NOT, _constants.AT):
        return {""}
    if op is _constants.IN and all(kind is _constants.LITERAL for kind, _ in value):
        return {chr(c) for _, c in value}
    if op is _constants.SUBPATTERN:
        return _all_forms(value[3])
    if op is _constants.BRANCH:
        held = [_all_forms(part) for part in value[1]]
        return None if None in held else set().union(*held)
    if op is _constants.MAX_REPEAT and value[1] == 1:
        held = _all_forms(value[2])
        return None if held is None else held | ({""} if value[0] == 0 else set())
    return None


def _all_forms(parts) -> set[str] | None:
    out = {""}
    for op, value in parts:
        held = _forms(op, value)
        if held is None or len(out) * len(held) > MAX_FORMS:
            return None
        out = {a + b for a in out for b in held}
    return out


def _candidates(parts):
    """Sets of texts of which every match holds one."""
    run = {""}
    for op, value in parts:
        held = _forms(op, value)
        if held is not None and len(run) * len(held) <= MAX_FORMS:
            run = {a + b for a in run for b in held}
            continue
        yield run
        run = held if held is not None and len(held) <= MAX_FORMS else {""}
        if held is None and op is _constants.SUBPATTERN:
            yield from _candidates(value[3])
        if held is None and op is _constants.BRANCH:
            inner = [_best(part) for part in value[1]]
            yield set().union(*inner)
    yield run


def _best(parts) -> set[str]:
    """Of the candidates, folded, that whose shortest text is longest."""
    folded = [{re.sub(_GAP, " ", form) for form in held} for held in _candidates(parts)]
    return max(folded, key=lambda held: (min(map(len, held)), -len(held)))


@cache
def keywords(pattern: re.Pattern) -> frozenset[str]:
    """Texts of which every match of the pattern holds one, once gaps are folded."""
    return frozenset(_best(_parser.parse(pattern.pattern, re.S)))


@cache
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    by_keyword: dict[str, list[int]] = {}
    for k, rule in enumerate(rules()):
        for keyword in keywords(rule.pattern):
            by_keyword.setdefault(keyword, []).append(k)
    for keyword in by_keyword:
        found.add_word(keyword, keyword)
    found.make_automaton()
    return found, by_keyword


@dataclass(frozen=True)
class Detection:
    rule: str
    label: str
    start: int
    end: int
    priority: int
    score: float


def resolve(found: list[Detection]) -> list[Detection]:
    """Detections that lie inside no accepted one, in order of place.

    The largest accepted end over all starts up to a place is kept in a Fenwick tree over the distinct starts, so that n detections
    take n log n steps.
    """
    starts = sorted({d.start for d in found})
    number = {s: k for k, s in enumerate(starts, 1)}
    reach = [-1] * (len(starts) + 1)
    taken: list[Detection] = []
    for d in sorted(found, key=lambda d: (-d.priority, d.start - d.end, d.start, d.rule)):
        k, furthest = number[d.start], -1
        while k:
            furthest = max(furthest, reach[k])
            k &= k - 1
        if furthest < d.end:
            taken.append(d)
            k = number[d.start]
            while k < len(reach):
                reach[k] = max(reach[k], d.end)
                k += k & -k
    return sorted(taken, key=lambda d: (d.start, d.end))


def detect(text: str) -> list[Detection]:
    """Detections in a text whose A-Z are lower-cased."""
    automaton, by_keyword = _automaton()
    hit = {k for keyword in {keyword for _, keyword in automaton.iter(_fold(text))} for k in by_keyword[keyword]}
    if not hit:
        return []
    flat = re.sub(r"[^\S ]", " ", text)  # white space of one kind, places unchanged
    found = [Detection(r.name, r.label, m.start(), m.end(), r.priority, r.score)
             for r in map(rules().__getitem__, sorted(hit)) for m in r.pattern.finditer(flat)]
    return resolve(found) if found else []


def _base_places(words, n_docs: int):
    """For each base phrase: indexes of the words where it starts."""
    hashes, doc = words.hashes, words.doc
    for phrase in BASE_PHRASES:
        parts = [np.frombuffer(w.encode(), np.uint8) for w in phrase.split()]
        wanted = [span_hash(p, np.array([0]), np.array([len(p)]))[0] for p in parts]
        last = len(hashes) - len(wanted) + 1
        if last <= 0:
            yield phrase, np.zeros(0, np.int64)
            continue
        places = np.flatnonzero(hashes[:last] == wanted[0])
        for j, h in enumerate(wanted[1:], 1):
            places = places[(hashes[places + j] == h) & (doc[places + j] == doc[places])]
        yield phrase, places


DETECTION = "array<struct<rule:string,label:string,start:long,end:long,priority:int,score:double>>"
RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections " + DETECTION)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document of (doc_id, text).

    n_base, first_word, last_word, base_labels: places and labels of the base phrases; labels: those and
    the rules'; score: the surest of them; detections: accepted matches, their places in code points.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RESULT.split(", ")]
        kind = pa.list_(pa.struct([("rule", pa.string()), ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("priority", pa.int32()), ("score", pa.float64())]))
        for batch in slices(batches, "text"):
            n = batch.num_rows
            words = split(batch.column(1), ALNUM)
            first_of, n_base = words.firsts, np.zeros(n, np.int64)
            first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            base: list[set[str]] = [set() for _ in range(n)]
            for phrase, places in _base_places(words, n):
                at = words.doc[places]
                np.add.at(n_base, at, 1)
                np.minimum.at(first, at, places - first_of[at])
                np.maximum.at(last, at, places - first_of[at])
                for k in np.unique(at):
                    base[k].add(BASE_PHRASES[phrase])
            low = words.data.tobytes()
            found = [detect(low[a:b].decode()) for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist())]
            some = n_base > 0
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(words.counts.astype(np.int64)), pa.array(n_base),
                pa.array(first, mask=~some), pa.array(last, mask=~some),
                pa.array([",".join(sorted(b)) for b in base]), pa.array([",".join(sorted(b | {d.label for d in f})) for b, f in zip(base, found)]),
                pa.array([max([d.score for d in f] + [BASE_SCORE] * bool(b), default=0.0) for b, f in zip(base, found)], pa.float64()),
                pa.array([[vars(d) for d in f] for f in found], kind)], names=names)

    return pick(docs, doc_id="long", text="string").mapInArrow(tidy(run), RESULT)


def license_rows(docs: DataFrame) -> DataFrame:
    return scan_licenses(docs).withColumn("n_detections", F.size("detections")).drop("detections")
