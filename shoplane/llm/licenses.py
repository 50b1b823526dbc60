"""License scans: ordered signature rules with keyword prefilter, priority and suppression by containment.

Rules are regexes over a text's words (A-Z lowered, words joined by single blanks). ``WRITTEN`` holds those written by hand: families
without a version, short forms, texts found in licenses. The others come from five forms filled from a table of licenses: full
name, notice ("licensed under ..."), file mention, address, and for some a sentence of their own. Each rule has keywords without
which it cannot match; one automaton finds which keywords a text has, and only rules with all of them run. License tags
("SPDX-License-Identifier:") are read as expressions from the text itself, where an identifier still has its hyphens: every
license of "(MIT OR Apache-2.0)" counts, and one the table does not have, such as MIT-0, counts for none.

Detections are taken by priority, then length, then start, then label; one whose words lie inside an accepted detection is dropped, so
a name inside a notice counts once and a family gives way to its version. A sweep over a tree of starts decides that, so a text with
any number of mentions takes time in proportion. A text's score is 1 - prod(1 - weight) over its accepted detections and base places, weights being fixed per form.

Base phrases are found wherever their words stand one after another, overlaps included, and always keep their labels.
Null texts are empty: no words, no labels, score 0. Repeated rows give repeated rows. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: phrases and labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: label: (names as words, identifiers as words, a telling word of the address, a sentence found in the license only)
LICENSES: dict[str, tuple[tuple[str, ...], tuple[str, ...], str, str]] = {
    "mit": (("mit license", "expat license"), ("mit",), "opensource org licenses mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    "apache-2.0": (("apache license version 2 0", "apache license 2 0", "apache 2 0 license"), ("apache 2 0",), "apache org licenses license 2 0", "unless required by applicable law or agreed to in writing software"),
    "bsd-2-clause": (("bsd 2 clause license", "simplified bsd license", "freebsd license"), ("bsd 2 clause",), "opensource org licenses bsd 2 clause", ""),
    "bsd-3-clause": (("bsd 3 clause license", "new bsd license", "modified bsd license"), ("bsd 3 clause",), "opensource org licenses bsd 3 clause", "neither the name of the copyright holder nor the names of its contributors"),
    "bsd-4-clause": (("bsd 4 clause license", "original bsd license"), ("bsd 4 clause",), "directory fsf org wiki license bsd 4clause", "all advertising materials mentioning features or use of this software"),
    "isc": (("isc license", "internet systems consortium license"), ("isc",), "opensource org licenses isc", "permission to use copy modify and or distribute this software for any purpose"),
    "gpl-2.0": (("gnu general public license version 2", "gnu gpl version 2", "gpl v2"), ("gpl 2 0", "gpl 2 0 only", "gpl 2 0 or later"), "gnu org licenses old licenses gpl 2 0", ""),
    "gpl-3.0": (("gnu general public license version 3", "gnu gpl version 3", "gpl v3"), ("gpl 3 0", "gpl 3 0 only", "gpl 3 0 or later"), "gnu org licenses gpl 3 0", ""),
    "lgpl-2.1": (("gnu lesser general public license version 2 1", "lgpl v2 1"), ("lgpl 2 1", "lgpl 2 1 only"), "gnu org licenses old licenses lgpl 2 1", ""),
    "lgpl-3.0": (("gnu lesser general public license version 3", "lgpl v3"), ("lgpl 3 0", "lgpl 3 0 only"), "gnu org licenses lgpl 3 0", ""),
    "agpl-3.0": (("gnu affero general public license version 3", "gnu affero general public license", "agpl v3"), ("agpl 3 0", "agpl 3 0 only"), "gnu org licenses agpl 3 0", "remote network interaction use with the gnu general public license"),
    "gfdl-1.3": (("gnu free documentation license",), ("gfdl 1 3",), "gnu org licenses fdl", "with no invariant sections no front cover texts"),
    "mpl-1.1": (("mozilla public license version 1 1", "mpl 1 1"), ("mpl 1 1",), "mozilla org mpl 1 1", ""),
    "mpl-2.0": (("mozilla public license version 2 0", "mozilla public license 2 0", "mpl 2 0"), ("mpl 2 0",), "mozilla org mpl 2 0", "this source code form is subject to the terms of the mozilla public license"),
    "epl-1.0": (("eclipse public license version 1 0", "eclipse public license v1 0"), ("epl 1 0",), "eclipse org legal epl v10", ""),
    "epl-2.0": (("eclipse public license version 2 0", "eclipse public license 2 0"), ("epl 2 0",), "eclipse org legal epl 2 0", ""),
    "cddl-1.0": (("common development and distribution license",), ("cddl 1 0",), "opensource org licenses cddl", ""),
    "artistic-2.0": (("artistic license 2 0", "artistic license version 2 0"), ("artistic 2 0",), "perlfoundation org artistic license 2 0", ""),
    "zlib": (("zlib license", "zlib libpng license"), ("zlib",), "zlib net zlib license", "this notice may not be removed or altered from any source distribution"),
    "boost-1.0": (("boost software license version 1 0", "boost software license"), ("bsl 1 0",), "boost org license 1 0", ""),
    "unlicense": (("the unlicense",), ("unlicense",), "unlicense org", "this is free and unencumbered software released into the public domain"),
    "wtfpl": (("do what the fuck you want to public license",), ("wtfpl",), "wtfpl net", ""),
    "cc0-1.0": (("cc0 1 0 universal", "creative commons zero"), ("cc0 1 0",), "creativecommons org publicdomain zero", ""),
    "cc-by-4.0": (("creative commons attribution 4 0", "cc by 4 0"), ("cc by 4 0",), "creativecommons org licenses by 4 0", ""),
    "cc-by-3.0": (("creative commons attribution 3 0", "cc by 3 0"), ("cc by 3 0",), "creativecommons org licenses by 3 0", ""),
    "cc-by-sa": (("creative commons attribution sharealike", "creative commons attribution share alike", "cc by sa"), ("cc by sa 4 0", "cc by sa 3 0"), "creativecommons org licenses by sa", ""),
    "cc-by-nc": (("creative commons attribution noncommercial", "creative commons attribution non commercial", "cc by nc"), ("cc by nc 4 0", "cc by nc 3 0"), "creativecommons org licenses by nc", ""),
    "cc-by-nd": (("creative commons attribution noderivatives", "creative commons attribution noderivs", "cc by nd"), ("cc by nd 4 0", "cc by nd 3 0"), "creativecommons org licenses by nd", ""),
    "cc-by-nc-sa": (("creative commons attribution noncommercial sharealike", "cc by nc sa"), ("cc by nc sa 4 0", "cc by nc sa 3 0"), "creativecommons org licenses by nc sa", ""),
    "cc-by-nc-nd": (("creative commons attribution noncommercial noderivatives", "cc by nc nd"), ("cc by nc nd 4 0", "cc by nc nd 3 0"), "creativecommons org licenses by nc nd", ""),
    "odbl-1.0": (("open database license", "open data commons open database license"), ("odbl 1 0",), "opendatacommons org licenses odbl", ""),
    "odc-by-1.0": (("open data commons attribution license",), ("odc by 1 0",), "opendatacommons org licenses by", ""),
    "pddl-1.0": (("public domain dedication and license",), ("pddl 1 0",), "opendatacommons org licenses pddl", ""),
    "ofl-1.1": (("sil open font license",), ("ofl 1 1",), "scripts sil org ofl", ""),
    "openrail": (("creativeml open rail m", "bigscience rail license", "openrail license"), ("creativeml openrail m",), "huggingface co spaces bigscience license", ""),
    "psf-2.0": (("python software foundation license", "psf license agreement"), ("psf 2 0", "python 2 0"), "docs python org license", ""),
    "php-3.01": (("php license version 3 01", "the php license"), ("php 3 01",), "php net license 3 01", ""),
    "ms-pl": (("microsoft public license",), ("ms pl",), "opensource org licenses ms pl", ""),
    "ms-rl": (("microsoft reciprocal license",), ("ms rl",), "opensource org licenses ms rl", ""),
    "eupl-1.2": (("european union public licence", "european union public license"), ("eupl 1 2", "eupl 1 1"), "joinup ec europa eu collection eupl", ""),
    "cecill-2.1": (("cecill free software license agreement", "cecill license"), ("cecill 2 1", "cecill 2 0"), "cecill info licences", ""),
    "osl-3.0": (("open software license version 3 0", "open software license"), ("osl 3 0",), "opensource org licenses osl 3 0", ""),
    "afl-3.0": (("academic free license version 3 0", "academic free license"), ("afl 3 0",), "opensource org licenses afl 3 0", ""),
    "sspl-1.0": (("server side public license",), ("sspl 1 0",), "mongodb com licensing server side public license", ""),
    "busl-1.1": (("business source license 1 1", "business source license"), ("busl 1 1",), "mariadb com bsl11", ""),
    "elastic-2.0": (("elastic license 2 0", "elastic license"), ("elastic 2 0",), "elastic co licensing elastic license", ""),
    "postgresql": (("postgresql license",), ("postgresql",), "postgresql org about licence", ""),
    "x11": (("x11 license",), ("x11",), "xfree86 org 3 3 6 copyright", ""),
    "ncsa": (("university of illinois ncsa open source license", "ncsa open source license"), ("ncsa",), "opensource org licenses ncsa", ""),
    "public-domain": (("released into the public domain", "dedicated to the public domain", "public domain dedication"), ("public domain",), "wiki creativecommons org wiki public domain", ""),
}

#: Forms: (priority, weight, regex around the alternatives of a license). Higher priorities go first.
FORMS = {
    "sentence": (5, 0.95, r"{sentence}"),
    "notice": (4, 0.9, r"(?:licensed|released|distributed|published|available|made available) (?:to you )?under (?:the )?(?:terms of )?(?:the )?(?:{names})"),
    "terms": (3, 0.8, r"(?:terms|conditions|copy|text) of (?:the )?(?:{names})"),
    "address": (2, 0.8, r"(?:https? )?(?:www )?{address}"),
    "name": (1, 0.6, r"(?:the )?(?:{names})"),
}
TAG_PRIORITY, TAG_WEIGHT = 6, 0.95
_NOTICE = r"(?:licen[sc]ed|released|distributed|published|available|provided|covered|redistributed|shared) (?:to you )?(?:under|by) (?:the )?(?:terms of )?(?:the )?"

#: Written by hand: (label, priority, weight, regex, keywords). Versions of the table win over families by priority and length.
WRITTEN: list[tuple[str, int, float, str, tuple[str, ...]]] = [
    ("apache", 0, 0.5, r"apache (?:software )?licen[sc]e", ("apache",)),
    ("apache-2.0", 2, 0.8, r"apache (?:software )?licen[sc]e (?:v|version )?2(?: 0)?", ("apache",)),
    ("apache-2.0", 2, 0.8, r"apache (?:v|version )?2 0", ("apache",)),
    ("apache-2.0", 2, 0.7, r"(?:asl|al) (?:v|version )?2(?: 0)?", ("asl|al ",)),
    ("apache", 3, 0.8, _NOTICE + r"apache (?:software )?licen[sc]e", ("apache",)),
    ("apache-1.1", 2, 0.8, r"apache (?:software )?licen[sc]e (?:v|version )?1 1", ("apache",)),
    ("mit", 0, 0.5, r"mit licen[sc]ed", ("mit licen",)),
    ("mit", 3, 0.8, _NOTICE + r"mit(?: x11)?(?: style)? licen[sc]e", ("mit",)),
    ("mit", 4, 0.9, r"the above copyright notice and this permission notice shall be included in all copies", ("permission notice shall be included",)),
    ("mit", 0, 0.5, r"mit (?:x11|style) licen[sc]e", ("mit ",)),
    ("bsd", 0, 0.5, r"bsd(?: style| type| like)? licen[sc]e", ("bsd",)),
    ("bsd", 0, 0.5, r"berkeley software distribution licen[sc]e", ("berkeley",)),
    ("bsd", 3, 0.8, _NOTICE + r"bsd(?: style)? licen[sc]e", ("bsd",)),
    ("bsd", 4, 0.9, r"redistribution and use in source and binary forms(?: with or without modification)?", ("redistribution and use in source and binary forms",)),
    ("bsd-2-clause", 2, 0.8, r"(?:2|two) clause bsd(?: licen[sc]e)?", ("clause bsd",)),
    ("bsd-3-clause", 2, 0.8, r"(?:3|three) clause bsd(?: licen[sc]e)?", ("clause bsd",)),
    ("bsd-3-clause", 2, 0.8, r"revised bsd licen[sc]e", ("revised bsd",)),
    ("bsd-3-clause", 4, 0.9, r"neither the names? of [a-z0-9 ]{1,80} nor the names? of (?:its|their) contributors", ("nor the name",)),
    ("gpl", 0, 0.5, r"gnu (?:general public licen[sc]e|gpl)", ("gnu g",)),
    ("gpl", 3, 0.8, _NOTICE + r"(?:gnu )?gpl", ("gpl",)),
    ("gpl", 4, 0.9, r"(?:gnu )?general public licen[sc]e as published by the free software foundation", ("free software foundation",)),
    ("gpl-1.0", 2, 0.8, r"(?:gnu )?gpl ?(?:v|version )?1(?: 0)?", ("gpl",)),
    ("gpl-2.0", 2, 0.8, r"(?:gnu )?gpl ?(?:v|version )?2(?: 0)?", ("gpl",)),
    ("gpl-3.0", 2, 0.8, r"(?:gnu )?gpl ?(?:v|version )?3(?: 0)?", ("gpl",)),
    ("gpl-2.0", 2, 0.8, r"(?:gnu )?general public licen[sc]e (?:v|version )?2(?: 0)?", ("general public licen",)),
    ("gpl-3.0", 2, 0.8, r"(?:gnu )?general public licen[sc]e (?:v|version )?3(?: 0)?", ("general public licen",)),
    ("lgpl", 0, 0.5, r"(?:gnu )?(?:lesser|library) general public licen[sc]e", ("general public licen",)),
    ("lgpl", 0, 0.5, r"(?:gnu )?lgpl", ("lgpl",)),
    ("lgpl", 3, 0.8, _NOTICE + r"(?:gnu )?(?:lgpl|(?:lesser|library) general public licen[sc]e)", ("lgpl|general public licen",)),
    ("lgpl-2.0", 2, 0.8, r"(?:gnu )?lgpl ?(?:v|version )?2(?: 0)?", ("lgpl",)),
    ("lgpl-2.1", 2, 0.8, r"(?:gnu )?lgpl ?(?:v|version )?2 1", ("lgpl",)),
    ("lgpl-3.0", 2, 0.8, r"(?:gnu )?lgpl ?(?:v|version )?3(?: 0)?", ("lgpl",)),
    ("agpl", 0, 0.5, r"(?:gnu )?(?:agpl|affero (?:general public licen[sc]e|gpl))", ("agpl|affero",)),
    ("agpl-3.0", 2, 0.8, r"(?:gnu )?agpl ?(?:v|version )?3(?: 0)?", ("agpl",)),
    ("gfdl", 0, 0.5, r"(?:gnu )?(?:gfdl|free documentation licen[sc]e)", ("gfdl|free documentation",)),
    ("mpl", 0, 0.5, r"mozilla public licen[sc]e", ("mozilla",)),
    ("mpl-2.0", 2, 0.8, r"mozilla public licen[sc]e (?:v|version )?2(?: 0)?", ("mozilla",)),
    ("mpl", 3, 0.8, _NOTICE + r"(?:mozilla public licen[sc]e|mpl)", ("mozilla|mpl",)),
    ("epl", 0, 0.5, r"eclipse public licen[sc]e", ("eclipse",)),
    ("epl-2.0", 2, 0.8, r"(?:eclipse public licen[sc]e|epl) (?:v|version )?2(?: 0)?", ("eclipse|epl",)),
    ("epl-1.0", 2, 0.8, r"(?:eclipse public licen[sc]e|epl) (?:v|version )?1(?: 0)?", ("eclipse|epl",)),
    ("cpl-1.0", 2, 0.7, r"common public licen[sc]e(?: (?:v|version )?1 0)?", ("common public",)),
    ("artistic", 0, 0.5, r"artistic licen[sc]e", ("artistic",)),
    ("artistic", 3, 0.8, r"(?:under )?the same terms as perl(?: itself)?", ("same terms as perl",)),
    ("isc", 3, 0.8, _NOTICE + r"isc licen[sc]e", ("isc",)),
    ("zlib", 4, 0.9, r"this software is provided as is without any express or implied warranty", ("as is without any express or implied warranty",)),
    ("boost-1.0", 2, 0.8, r"boost software licen[sc]e(?: (?:v|version )?1 0)?", ("boost",)),
    ("cc", 0, 0.5, r"creative commons(?: [a-z]+){0,3} licen[sc]e", ("creative commons",)),
    ("cc-by", 1, 0.6, r"creative commons attribution(?: licen[sc]e)?", ("creative commons",)),
    ("cc-by", 3, 0.8, _NOTICE + r"(?:a )?creative commons attribution(?: licen[sc]e)?", ("creative commons",)),
    ("cc-by-sa", 2, 0.8, r"creative commons attribution share ?alike(?: licen[sc]e)?(?: [1-4] 0)?", ("creative commons",)),
    ("cc-by-nc", 2, 0.8, r"creative commons attribution non ?commercial(?: licen[sc]e)?(?: [1-4] 0)?", ("creative commons",)),
    ("cc-by-nd", 2, 0.8, r"creative commons attribution no ?deriv(?:s|atives)(?: licen[sc]e)?(?: [1-4] 0)?", ("creative commons",)),
    ("cc0-1.0", 2, 0.8, r"cc0(?: 1 0)?(?: universal| licen[sc]e)?", ("cc0",)),
    ("public-domain", 3, 0.8, r"(?:is|are|placed|hereby placed) in the public domain", ("in the public domain",)),
    ("public-domain", 3, 0.8, r"no rights reserved", ("no rights reserved",)),
    ("unlicense", 4, 0.9, r"anyone is free to copy modify publish use compile sell or distribute this software", ("anyone is free to copy",)),
    ("wtfpl", 0, 0.6, r"wtfpl(?: (?:v|version )?2)?", ("wtfpl",)),
    ("eupl", 0, 0.5, r"eupl", ("eupl",)),
    ("cddl", 0, 0.5, r"cddl", ("cddl",)),
    ("openssl", 1, 0.6, r"openssl licen[sc]e", ("openssl",)),
    ("python", 0, 0.5, r"python licen[sc]e", ("python licen",)),
    ("ruby", 1, 0.6, r"ruby licen[sc]e|under the same terms as ruby", ("ruby",)),
    ("vim", 1, 0.6, r"vim licen[sc]e", ("vim licen",)),
    ("beerware", 1, 0.6, r"beer ?ware licen[sc]e", ("beer",)),
    ("json", 4, 0.8, r"the software shall be used for good not evil", ("for good not evil",)),
    ("commercial", 1, 0.5, r"(?:commercial|enterprise|proprietary) licen[sc]e(?: agreement)?", ("commercial|enterprise|proprietary",)),
    ("eula", 1, 0.5, r"end user licen[sc]e agreement", ("end user licen",)),
]

#: General statements that name no license.
STATEMENTS = {
    "copyright": (1, 0.4, r"copyright (?:c )?(?:19|20)[0-9]{2}", ("copyright",)),
    "proprietary": (3, 0.7, r"(?:proprietary and confidential|unauthorized copying of this (?:file|document|work))", ("proprietary|unauthorized",)),
    "permission": (2, 0.5, r"(?:used|reprinted|reproduced) (?:with|by) (?:the )?permission", ("permission",)),
    "no-redistribution": (3, 0.7, r"(?:may not be|must not be|not to be) (?:reproduced|redistributed|copied|republished)", ("reproduced|redistributed|copied|republished",)),
}
BASE_WEIGHT = 0.6
#: Everything that is no word character of the contract becomes a blank; A-Z become a-z.
_BLANKS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def rules() -> list[tuple[str, str, int, float, str, tuple[str, ...]]]:
    """(name, label, priority, weight, regex, keywords): a text must hold one alternative of every keyword."""
    out = []
    for label, (names, _, address, sentence) in LICENSES.items():
        for form, (priority, weight, pattern) in FORMS.items():
            if form == "sentence" and not sentence:
                continue
            filled = pattern.format(names="|".join(names), address=address, sentence=sentence)
            longest = {"sentence": [sentence], "address": [address]}.get(form, [])
            keywords = tuple(longest) if longest else ("|".join(names),)
            out.append((f"{label}:{form}", label, priority, weight, filled, keywords))
    for number, (label, priority, weight, pattern, keywords) in enumerate(WRITTEN):
        out.append((f"{label}:written {number}", label, priority, weight, f"(?:{pattern})", keywords))
    for label, (priority, weight, pattern, keywords) in STATEMENTS.items():
        out.append((f"{label}:statement", label, priority, weight, pattern, keywords))
    return sorted(out, key=lambda rule: (-rule[2], rule[0]))


@lru_cache(maxsize=1)
def _compiled():
    import ahocorasick

    automaton, listed = ahocorasick.Automaton(), []
    for _, label, priority, weight, pattern, keywords in rules():
        groups = tuple(frozenset(group.split("|")) for group in keywords)
        for word in frozenset().union(*groups):
            automaton.add_word(word, word)
        listed.append((label, priority, weight, re.compile(f"(?<= ){pattern}(?= )"), groups))
    automaton.make_automaton()
    phrases = [(phrase, BASE[phrase], re.compile(f"(?= {phrase} )")) for phrase in BASE]
    return automaton, listed, phrases


_TAG = re.compile(rb"SPDX-License-Identifier:", re.IGNORECASE)
_ATOM = re.compile(rb"[ \t()]*([A-Za-z0-9.+-]+)")
_IDS = {identifier: label for label, (_, ids, _, _) in LICENSES.items() for identifier in ids}
_OPERATORS = (b"and", b"or", b"with")


def tag_licenses(text: bytes) -> list[tuple[int, int, list[str]]]:
    """(start, end, labels) in bytes of every license tag with its expression: identifiers joined by AND, OR and WITH."""
    found = []
    for tag in _TAG.finditer(text):
        at, labels, wanted, excepted = tag.end(), [], True, False
        while atom := _ATOM.match(text, at):
            word = atom[1].lower()
            if wanted == (word in _OPERATORS):  # an operator where an identifier should be, or the other way round
                break
            if wanted and not excepted:
                label = _IDS.get(re.sub("[^a-z0-9]+", " ", word.decode()).strip())
                labels += [label] if label else []
            excepted = not wanted and word == b"with"
            wanted, at = not wanted, atom.end()
        found.append((tag.start(), at, labels))
    return found


class _Covers:
    """Accepted spans; tells whether one of them holds a span, in time logarithmic in the number of starts."""

    def __init__(self, starts: list[int]):
        self.starts = sorted(set(starts))
        self.furthest = [-1] * (len(self.starts) + 1)  # greatest end in blocks of starts, as in a binary indexed tree

    def add(self, start: int, end: int) -> None:
        at = bisect_right(self.starts, start)
        while at <= len(self.starts):
            self.furthest[at] = max(self.furthest[at], end)
            at += at & -at

    def holds(self, start: int, end: int) -> bool:
        at = bisect_right(self.starts, start)
        while at:
            if self.furthest[at] >= end:
                return True
            at -= at & -at
        return False


def detections(words: str, tags: list[tuple[int, int, list[str]]] = ()) -> list[tuple[int, int, str, float]]:
    """Accepted (first character, end, label, weight) in a padded line of words; ``tags`` are license tags, in the line's characters."""
    automaton, listed, _ = _compiled()
    present = {word for _, word in automaton.iter(words)}
    found = []
    for label, priority, weight, pattern, groups in listed:
        if all(group & present for group in groups):
            found += [(priority, m.end() - m.start(), m.start(), label, weight) for m in pattern.finditer(words)]
    accepted: list[tuple[int, int, str, float]] = [(start, end, label, TAG_WEIGHT) for start, end, labels in tags for label in labels]
    covers = _Covers([start for _, _, start, _, _ in found] + [start for start, _, _ in tags])
    for start, end, _ in tags:
        covers.add(start, end)
    for _, length, start, label, weight in sorted(found, key=lambda f: (-f[0], -f[1], f[2], f[3])):
        if not covers.holds(start, start + length):
            accepted.append((start, start + length, label, weight))
            covers.add(start, start + length)
    return accepted


def _in_line(text: bytes, words: list[bytes], tags: list[tuple[int, int, list[str]]]) -> list[tuple[int, int, list[str]]]:
    """License tags by their place in the padded line of words."""
    if not tags:
        return []
    places = [1]
    for word in words:
        places.append(places[-1] + len(word.decode("utf-8", "replace")) + 1)
    out, done, n = [], 0, 0
    for start, end, labels in tags:
        n += len(text[done:start].translate(_BLANKS).split())
        inside = len(text[start:end].translate(_BLANKS).split())
        out.append((places[n], places[n + inside] - 1, labels))
        done, n = end, n + inside
    return out


def examine(text: bytes) -> tuple[int, int, int | None, int | None, str, str, float]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    words = text.translate(_BLANKS).split()
    line = f" {b' '.join(words).decode('utf-8', 'replace')} "
    _, _, phrases = _compiled()
    places, base_labels = [], set()
    for phrase, label, pattern in phrases:
        if phrase in line:
            done, before = 0, 0
            for match in pattern.finditer(line):
                before += line.count(" ", done, match.start())
                done = match.start()
                places.append(before)
                base_labels.add(label)
    kept = detections(line, _in_line(text, words, tag_licenses(text)))
    doubt = (1 - BASE_WEIGHT) ** len(places)
    for _, _, _, weight in kept:
        doubt *= 1 - weight
    labels = base_labels | {label for _, _, label, _ in kept}
    first, last = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted(base_labels)), ",".join(sorted(labels)), 1 - doubt


def scan(documents: DataFrame) -> DataFrame:
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]

    def look(batches):
        for batch in batches:
            rows = [(doc_id, *examine(text)) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    given = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    )
    return given.mapInArrow(look, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
