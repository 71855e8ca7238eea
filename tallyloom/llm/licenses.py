"""Licence detection by ordered signature rules, in column expressions only.

Words are runs of letters, digits and characters beyond ASCII, A-Z lowered.
Rules are regular expressions over the words joined by single spaces. Each has
a keyword that all its matches hold, and each keyword a stem with which one of
its words begins: one literal expression finds the stems of a text, keywords of
these stems are looked for, and expressions of these keywords are run, so
neither gate loses a match. All forms of a name are run as one expression; how
a match begins tells its form. Rules are ordered by priority; a detection is suppressed where another one of the same or a
higher priority contains its interval, the first rule winning among equals.
"Not licensed under" a name has the highest priority and no label, so what it
contains is suppressed. Short names that mean other things as well count only
where a text is said to be under them.

Base phrases are counted apart, at all their places, and their labels stay.

Defined cases: a null text is an empty one; a text without words has no
places, no labels and score 0; repeated rows are scanned one by one; an empty
table gives no rows; further columns are not read.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases whose places are counted, and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: How names of Creative Commons begin, each a keyword of its own, and how they go on, with labels.
_CC = ("cc by", "cc attribution", "creative commons by", "creative commons attribution")
_CC_PARTS = (
    ("cc-by-nc-nd", r" (?:nc|non ?commercial) (?:nd|no ?deriv(?:ative)?s?)(?: \d 0)?"),
    ("cc-by-nc-sa", r" (?:nc|non ?commercial) (?:sa|share ?alike)(?: \d 0)?"),
    ("cc-by-nc", r" (?:nc|non ?commercial)(?: \d 0)?"),
    ("cc-by-nd", r" (?:nd|no ?deriv(?:ative)?s?)(?: \d 0)?"),
    ("cc-by-sa", r" (?:sa|share ?alike)(?: \d 0)?"),
    ("cc-by-4.0", r" 4 0"),
    ("cc-by-3.0", r" 3 0"),
)

#: Label, keyword that every match holds, name as an expression over words without alternatives outside of groups.
#: Versions are optional digits as written in headers.
FAMILIES = (
    ("agpl-3.0", "affero", r"gnu affero general public licen[cs]e(?: version 3| v3)?"),
    ("agpl-3.0", "agpl", r"agpl(?: ?v?3(?: 0)?)?"),
    ("lgpl-2.1", "lesser", r"gnu lesser general public licen[cs]e (?:version |v )?2(?: 1)?"),
    ("lgpl-3.0", "lesser", r"gnu lesser general public licen[cs]e (?:version |v )?3(?: 0)?"),
    ("lgpl", "lesser", r"gnu lesser general public licen[cs]e"),
    ("lgpl-2.0", "library general", r"gnu library general public licen[cs]e"),
    ("gfdl", "free documentation", r"gnu free documentation licen[cs]e"),
    ("gpl-2.0", "general public", r"gnu general public licen[cs]e (?:version |v )?2(?: 0)?"),
    ("gpl-3.0", "general public", r"gnu general public licen[cs]e (?:version |v )?3(?: 0)?"),
    ("gpl", "general public", r"(?:gnu )?general public licen[cs]e"),
    ("apache-1.1", "apache", r"apache (?:software )?licen[cs]e (?:version |v )?1 1"),
    ("apache-2.0", "apache", r"apache (?:software )?licen[cs]e (?:version |v )?2(?: 0)?"),
    ("apache", "apache", r"apache (?:software )?licen[cs]e"),
    ("mit-0", " mit ", r"mit no attribution licen[cs]e"),
    ("mit", " mit ", r"mit (?:x11 |expat )?licen[cs]e"),
    ("x11", "x11", r"x11 licen[cs]e"),
    ("expat", "expat", r"expat licen[cs]e"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd) licen[cs]e"),
    ("bsd-2-clause", "freebsd", r"freebsd licen[cs]e"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd) licen[cs]e"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd) licen[cs]e"),
    ("bsd", "bsd", r"bsd(?: style)? licen[cs]e"),
    ("isc", " isc ", r"isc licen[cs]e"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e (?:version |v )?1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[cs]e (?:version |v )?2(?: 0)?"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e"),
    ("epl-1.0", "eclipse", r"eclipse public licen[cs]e (?:version |v )?1(?: 0)?"),
    ("epl-2.0", "eclipse", r"eclipse public licen[cs]e (?:version |v )?2(?: 0)?"),
    ("epl", "eclipse", r"eclipse public licen[cs]e"),
    ("cddl", "common development", r"common development and distribution licen[cs]e"),
    ("eupl", "european union", r"european union public licen[cs]e"),
    ("artistic-2.0", "artistic", r"artistic licen[cs]e(?: version)? 2(?: 0)?"),
    ("artistic", "artistic", r"artistic licen[cs]e"),
    ("bsl-1.0", "boost", r"boost software licen[cs]e"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e"),
    ("openssl", "openssl", r"openssl licen[cs]e"),
    ("python", "python", r"python(?: software foundation)? licen[cs]e"),
    ("php", "php", r"php licen[cs]e"),
    ("ruby", "ruby", r"ruby licen[cs]e"),
    ("wtfpl", "wtfpl", r"wtfpl(?: licen[cs]e)?"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("ofl-1.1", "open font", r"(?:sil )?open font licen[cs]e"),
    ("odbl", "open database", r"open database licen[cs]e"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[cs]e"),
    ("afl", "academic free", r"academic free licen[cs]e"),
    ("osl", "open software", r"open software licen[cs]e"),
    ("cpl", "common public", r"common public licen[cs]e"),
    ("qpl", "q public", r"q public licen[cs]e"),
    ("sspl", "server side", r"server side public licen[cs]e"),
    ("bsl-source", "business source", r"business source licen[cs]e"),
    ("elastic", "elastic", r"elastic licen[cs]e"),
    *((label, start, start + rest) for label, rest in _CC_PARTS for start in _CC),
    ("cc-by", "cc by", r"cc by(?: \d 0)?"),
    ("cc-by", "creative commons attribution", r"creative commons attribution(?: licen[cs]e)?"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("public-domain", "public domain", r"(?:in|into|to) the public domain"),
    ("proprietary", "rights reserved", r"copyright (?:[^ ]+ ){1,6}all rights reserved"),
)


#: Label, keyword, and an expression over words of a licence's own text or of the notice that it asks for.
_MIT_OPENING = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files (?:the software )?to deal"
)
_GNU_NOTICE = r" public licen[cs]e as published by the free software foundation (?:either )?(?:version|v) "
NOTICES = (
    ("mit-0", "permission is hereby granted", _MIT_OPENING + r" in the software without restriction (?:[^ ]+ ){20,40}furnished to do so the software is provided as is"),
    ("mit", "permission is hereby granted", _MIT_OPENING + r" in the software"),
    ("ncsa", "permission is hereby granted", _MIT_OPENING + r" with the software"),
    ("bsl-1.0", "permission is hereby granted", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[cs]e"),
    ("bsd", "redistribution and use in source", r"redistribution and use in source and binary forms(?: with or without modification)?"),
    ("bsd-3-clause", "neither the name of", r"neither the name of (?:[^ ]+ ){1,20}may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising materials mentioning", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("0bsd", "permission to use copy modify", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("isc", "permission to use copy modify", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that"),
    ("apache-2.0", "irrevocable copyright licen", r"grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright licen[cs]e"),
    *(
        (label, f"gnu {name} public licen", f"gnu {name}{_GNU_NOTICE}{version}")
        for name, label, version in (
            ("affero general", "agpl-3.0", "3(?: 0)?"), ("lesser general", "lgpl-2.1", "2 1"), ("lesser general", "lgpl-3.0", "3(?: 0)?"),
            ("library general", "lgpl-2.0", "2(?: 0)?"), ("general", "gpl-2.0", "2(?: 0)?"), ("general", "gpl-3.0", "3(?: 0)?"),
        )
    ),
    ("mpl-2.0", "source code form is subject to", r"this source code form is subject to the terms of the mozilla public licen[cs]e (?:version|v) 2 0"),
    ("zlib", "without any express or implied warranty", r"this software is provided as is without any express or implied warranty in no event will the authors? be held liable"),
    ("unlicense", "free and unencumbered software", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "what the fuck you want to", r"do what the fuck you want to public licen[cs]e"),
    ("cc0", "with this deed has dedicated", r"the person who associated a work with this deed has dedicated the work to the public domain"),
)

#: How versions follow short names: "v2", "2.0", "version 2.1", "-3.0".
_V = "(?: version)? ?v?"
#: Label, keyword, expression of a short name, and whether it counts by itself or only behind "licensed under" and the like.
SHORT = (
    ("lgpl-2.1", " lgpl", rf"(?:gnu )?lgpl{_V}2 1", True), ("lgpl-2.0", " lgpl", rf"(?:gnu )?lgpl{_V}2(?: 0)?", True),
    ("lgpl-3.0", " lgpl", rf"(?:gnu )?lgpl{_V}3(?: 0)?", True), ("lgpl", " lgpl", "(?:gnu )?lgpl", True),
    ("gpl-2.0", " gpl", rf"(?:gnu )?gpl{_V}2(?: 0)?", True), ("gpl-3.0", " gpl", rf"(?:gnu )?gpl{_V}3(?: 0)?", True),
    ("gpl", " gpl", "(?:gnu )?gpl(?: ?v?1)?", True), ("gfdl", " gfdl", rf"(?:gnu )?gfdl(?:{_V}1 [123])?", True), ("gfdl", "gnu fdl", "gnu fdl", True),
    ("apache-1.1", "apache", f"apache{_V}1 1", True), ("apache-2.0", "apache", f"apache{_V}2 0", True), ("apache-2.0", "apache", "apache ?v?2", False),
    ("apache-2.0", " asl", f"asl{_V}2(?: 0)?", False), ("apache", "apache", "apache", False), ("mit", " mit ", "mit(?: x11)?", False),
    ("mit-0", " mit 0", "mit 0", True), ("x11", " x11 ", "x11", False), ("expat", "expat", "expat", False), ("0bsd", " 0bsd", "0bsd(?: licen[cs]e)?", True),
    ("bsd-2-clause", " bsd", "bsd 2 clause", True), ("bsd-2-clause", " bsd", "bsd(?: style)? licen[cs]e 2 clause", True),
    ("bsd-2-clause", "clause bsd", "(?:2|two) clause bsd(?: licen[cs]e)?", True), ("bsd-3-clause", " bsd", "bsd 3 clause", True),
    ("bsd-3-clause", " bsd", "bsd(?: style)? licen[cs]e 3 clause", True), ("bsd-3-clause", "clause bsd", "(?:3|three) clause bsd(?: licen[cs]e)?", True),
    ("bsd-4-clause", " bsd", "bsd 4 clause", True), ("bsd-4-clause", " bsd", "bsd(?: style)? licen[cs]e 4 clause", True),
    ("bsd-4-clause", "clause bsd", "(?:4|four) clause bsd(?: licen[cs]e)?", True), ("bsd", " bsd", "bsd", False), ("isc", " isc ", "isc", False),
    ("mpl-1.1", " mpl", f"mpl{_V}1 1", True), ("mpl-2.0", " mpl", f"mpl{_V}2 0", True), ("mpl-2.0", " mpl", "mpl ?v?2", False), ("mpl", " mpl", "mpl", False),
    ("epl-1.0", " epl", f"epl{_V}1 0", True), ("epl-2.0", " epl", f"epl{_V}2 0", True), ("epl", " epl", "epl(?: ?v?[12])?", False),
    ("cddl", " cddl", f"cddl(?:{_V}1 [01])?", True), ("eupl", " eupl", f"eupl(?:{_V}1 [012])?", True), ("cpl", " cpl", f"cpl{_V}1 0", True),
    ("artistic-2.0", "artistic", f"artistic{_V}2 0", True), ("artistic", "artistic", "artistic", False), ("bsl-1.0", "boost", f"boost(?:{_V}1 0)?", False),
    ("zlib", " zlib", "zlib", False), ("openssl", "openssl", "openssl", False), ("ofl-1.1", " ofl", f"(?:sil )?ofl(?:{_V}1 [01])?", True),
    ("odbl", " odbl", f"odbl(?:{_V}1 0)?", True), ("ms-pl", " ms pl", "ms pl", True), ("ms-rl", " ms rl", "ms rl", True),
    ("ms-rl", "reciprocal", "microsoft reciprocal licen[cs]e", True), ("ncsa", " ncsa", "ncsa", False), ("python", " psf", "psf", False),
    ("afl", " afl", f"afl{_V}[123] [012]", True), ("osl", " osl", f"osl{_V}[123] [01]", True), ("qpl", " qpl", f"qpl(?:{_V}1 0)?", False),
    ("sspl", " sspl", f"sspl(?:{_V}1(?: 0)?)?", True), ("bsl-source", " busl", f"busl(?:{_V}1 1)?", True), ("elastic", "elastic", f"elastic{_V}2(?: 0)?", False),
    ("unlicense", "unlicen", "unlicen[cs]ed", False), ("cc0", "creative commons", "creative commons (?:zero|0)(?: 1 0)?(?: universal)?", True),
    ("cc0", " cc zero", "cc zero", True), ("cc-sa", " cc sa", r"cc sa(?: \d 0)?", True), ("upl-1.0", " upl", f"upl{_V}1 0", True),
    ("upl-1.0", "universal permissive", "universal permissive licen[cs]e", True), ("lppl", " lppl", f"lppl(?:{_V}1 [0123][abc]?)?", True),
    ("lppl", "latex project", "latex project public licen[cs]e", True), ("cecill", " cecill", r"cecill(?: [bc])?(?: ?v?\d(?: \d)?)?", True),
    ("nasa", "nasa open", "nasa open source agreement", True), ("postgresql", "postgresql", "postgresql licen[cs]e", True),
    ("mulan", " mulan", f"mulan (?:psl|permissive software licen[cs]e)(?:{_V}[12])?", True), ("vim", " vim ", "vim licen[cs]e", True),
    ("curl", " curl ", "curl licen[cs]e", True), ("json", " json ", "json licen[cs]e", True), ("beerware", "beerware", "beerware(?: licen[cs]e)?", True),
    ("beerware", "beer ware", "beer ware licen[cs]e", True), ("zpl", "zope", f"zope public licen[cs]e(?:{_V}[12] [01])?", True),
    ("w3c", " w3c ", "w3c software (?:notice|and document)", True), ("edl", "eclipse", "eclipse distribution licen[cs]e", True),
    ("ogl", "open government", "open government licen[cs]e", True), ("odc-by", " odc by", "odc by(?: 1 0)?", True),
    ("odc-by", "open data", "open data commons attribution licen[cs]e", True), ("pddl", " pddl", "pddl(?: 1 0)?", False),
    ("pddl", "public domain dedication", "public domain dedication and licen[cs]e", True), ("ipl", "ibm public", "ibm public licen[cs]e", True),
    ("npl", "netscape", "netscape public licen[cs]e", True), ("spl", "sun public", "sun public licen[cs]e", True),
    ("apsl", "apple public", "apple public source licen[cs]e", True), ("apsl", " apsl", f"apsl(?:{_V}[12] 0)?", True),
    ("blueoak", "blue oak", "blue oak model licen[cs]e", True), ("hippocratic", "hippocratic", "hippocratic licen[cs]e", True),
    ("polyform", "polyform", "polyform (?:noncommercial|small business|shield|strict) licen[cs]e", True),
    ("commons-clause", "commons clause", "commons clause", True), ("openrail", "openrail", "(?:creativeml )?openrail(?: m)?", False),
    ("openrail", " rail", "(?:(?:creativeml )?open|(?:creativeml )?bigscience) rail(?: m)?", False),
    ("llama", " llama", "llama [23](?: [12])? community licen[cs]e", True), ("opl", "open publication", "open publication licen[cs]e", True),
    ("rpl", "reciprocal public", "reciprocal public licen[cs]e", True), ("cal", "cryptographic autonomy", "cryptographic autonomy licen[cs]e", True),
    ("hpnd", "historical permission", "historical permission notice and disclaimer", True), ("ijg", "independent jpeg", "independent jpeg group licen[cs]e", True),
    ("libpng", " libpng", "libpng licen[cs]e", True), ("imagemagick", "imagemagick", "imagemagick licen[cs]e", True), ("tcl", " tcl", "tcl(?: tk)? licen[cs]e", True),
    ("ecl", "educational community", "educational community licen[cs]e", True), ("aladdin", "aladdin", "aladdin free public licen[cs]e", True),
    ("sleepycat", "sleepycat", "sleepycat licen[cs]e", True), ("watcom", "watcom", "(?:sybase )?open watcom public licen[cs]e", True),
    ("nposl", "non profit open", "non profit open software licen[cs]e", True), ("freetype", "freetype", "freetype(?: project)? licen[cs]e", True),
)

#: Label and SPDX identifier over words ("GPL-2.0-only" is "gpl 2 0 only", "GPL-2.0+" is "gpl 2 0").
_LATER = "(?: only| or later)?"
SPDX = (
    ("agpl-3.0", "agpl 3 0" + _LATER), ("agpl", "agpl 1 0" + _LATER), ("lgpl-2.0", "lgpl 2 0" + _LATER), ("lgpl-2.1", "lgpl 2 1" + _LATER),
    ("lgpl-3.0", "lgpl 3 0" + _LATER), ("gfdl", r"gfdl 1 \d(?:(?: no)? invariants)?" + _LATER), ("gpl", "gpl 1 0" + _LATER),
    ("gpl-2.0", "gpl 2 0" + _LATER), ("gpl-3.0", "gpl 3 0" + _LATER), ("apache", "apache 1 0"), ("apache-1.1", "apache 1 1"), ("apache-2.0", "apache 2 0"),
    ("mit-0", "mit 0"), ("mit", "mit"), ("x11", "x11"), ("0bsd", "0bsd"), ("bsd", "bsd 1 clause"), ("bsd-2-clause", "bsd 2 clause"),
    ("bsd-3-clause", "bsd 3 clause"), ("bsd-4-clause", "bsd 4 clause"), ("isc", "isc"), ("mpl", "mpl 1 0"), ("mpl-1.1", "mpl 1 1"),
    ("mpl-2.0", "mpl 2 0"), ("epl-1.0", "epl 1 0"), ("epl-2.0", "epl 2 0"), ("cddl", r"cddl 1 \d"), ("eupl", r"eupl 1 \d"),
    ("artistic", "artistic 1 0"), ("artistic-2.0", "artistic 2 0"), ("bsl-1.0", "bsl 1 0"), ("zlib", "zlib"), ("openssl", "openssl"),
    ("python", "(?:python|psf) 2 0"), ("php", "php 3 01?"), ("ruby", "ruby"), ("wtfpl", "wtfpl"), ("unlicense", "unlicense"), ("ofl-1.1", "ofl 1 1"),
    ("odbl", "odbl 1 0"), ("ms-pl", "ms pl"), ("ncsa", "ncsa"), ("afl", r"afl \d \d"), ("osl", r"osl \d \d"), ("cpl", "cpl 1 0"), ("qpl", "qpl 1 0"),
    ("sspl", "sspl 1 0"), ("bsl-source", "busl 1 1"), ("elastic", "elastic 2 0"), ("cc-by-nc-nd", r"cc by nc nd \d \d"),
    ("cc-by-nc-sa", r"cc by nc sa \d \d"), ("cc-by-nc", r"cc by nc \d \d"), ("cc-by-nd", r"cc by nd \d \d"), ("cc-by-sa", r"cc by sa \d \d"),
    ("cc-by-4.0", "cc by 4 0"), ("cc-by-3.0", "cc by 3 0"), ("cc-by", r"cc by [12] \d"), ("cc0", "cc0 1 0"),
)
_SPDX_START = "spdx license identifier"
#: Identifiers of an expression joined by "or" and "and" that are read.
_OPERANDS = 4


def _spdx_rules() -> list[tuple[str, str, str, int, float]]:
    """One rule for each identifier and place in an expression; an earlier place has the higher priority, as later spans contain it."""
    some = "|".join(name for _, name in SPDX)
    before = rf"(?:(?:{some})(?: with (?:[^ ]+ ){{1,3}}exception(?: \d \d)?)? (?:or|and) )"
    return [
        (label, _SPDX_START, f"(?<= ){_SPDX_START} {before + f'{{{place}}}' if place else ''}{name}(?= )", 3 + _OPERANDS - place, 1.0)
        for label, name in SPDX
        for place in range(_OPERANDS)
    ]


#: How a name stands in a text: beginnings of a match, expression before the name, priority, weight. A notice outranks a bare name.
_VERBS = ("licensed", "released", "distributed", "available", "published", "provided", "covered", "dual licensed")
_UNDER = r" under (?:the )?(?:terms of )?(?:the )?"
FORMS = (
    (tuple(f"{verb} under " for verb in _VERBS), f"(?:{'|'.join(_VERBS)}){_UNDER}", 3, 1.0),
    (("under the ",), r"under the (?:terms|conditions) (?:and conditions )?of (?:the )?", 3, 0.9),
    (("subject to ", "governed by ", "see "), r"(?:subject to|governed by|see) (?:the )?(?:terms of )?(?:the )?", 2, 0.7),
    (("",), "", 2, 0.6),
)

#: A name that is denied: no label, above all others.
_DENIED = f"not (?:{'|'.join(_VERBS[:-1])}){_UNDER}"
_DENIAL = 3 + _OPERANDS + 1
#: The first two forms say that something is under the licence.
_SAYING = 2

_EMPTY = "array<struct<first:int,last:int,label:string,rule:int,priority:int,weight:double>>"


_NAMED = (*((*family, True) for family in FAMILIES), *SHORT)


def _forms(alone: bool) -> tuple:
    return FORMS if alone else FORMS[:_SAYING]


def rules() -> list[tuple[int, str, str, str, int, float]]:
    """(order, label, keyword, expression, priority, weight): names in their forms, notices, SPDX identifiers, in order."""
    made = [
        (label, keyword, f"(?<= ){before}(?:{name})(?= )", priority, weight)
        for label, keyword, name, alone in _NAMED
        for _, before, priority, weight in _forms(alone)
    ]
    made += [("", keyword, f"(?<= ){_DENIED}(?:{name})(?= )", _DENIAL, 0.0) for _, keyword, name, _ in _NAMED]
    made += [(label, keyword, f"(?<= ){expression}(?= )", 3, 1.0) for label, keyword, expression in NOTICES]
    return [(i, *rule) for i, rule in enumerate(made + _spdx_rules())]


def _stem(keyword: str) -> str:
    """The longest word of a keyword that is not about licences as such."""
    own = keyword.split()
    return max([word for word in own if not word.startswith("licen")] or own, key=len)


def _stems() -> tuple[str, ...]:
    """Stems one of which begins a word in every match of a rule; none begins another."""
    every = sorted({_stem(keyword) for _, _, keyword, *_ in rules()})
    return tuple(s for s in every if not any(s != t and s.startswith(t) for t in every))


STEMS = _stems()


def _runs() -> list[dict]:
    """Expressions to run by stem and keyword, with the rule that a match belongs to by its beginning.

    The forms of a name become one expression, as no name ends where a form begins. A name with free words
    may swallow the beginning of a form and keeps one expression for each.
    """
    every, groups, at = rules(), {}, 0

    def add(expression: str, own: list, starts: list) -> None:
        keyword = own[0][2]
        stem = next(s for s in STEMS if _stem(keyword).startswith(s))
        forms = [
            {"starts": start, "rule": i, "label": label, "priority": priority, "weight": weight}
            for start, (i, label, _, _, priority, weight) in zip(starts, own, strict=True)
        ]
        group = groups.setdefault(keyword, {"stem": stem, "keyword": keyword, "rules": []})
        group["rules"].append({"expression": expression, "forms": forms})

    denials = sum(len(_forms(alone)) for *_, alone in _NAMED)
    for n, (_, _, name, alone) in enumerate(_NAMED):
        forms = _forms(alone)
        own = [every[denials + n], *every[at : at + len(forms)]]
        at += len(forms)
        if "[^ ]" in name:
            for rule in own:
                add(rule[3], [rule], [("",)])
        else:
            before = "|".join([_DENIED, *(before for _, before, *_ in forms if before)])
            add(f"(?<= )(?:{before}){'?' if alone else ''}(?:{name})(?= )", own, [("not ",), *(starts for starts, *_ in forms)])
    for rule in every[denials + len(_NAMED) :]:
        add(rule[3], [rule], [("",)])
    return list(groups.values())


_RUNS = (
    "array<struct<stem:string,keyword:string,rules:array<struct<expression:string,"
    "forms:array<struct<starts:array<string>,rule:int,label:string,priority:int,weight:double>>>>>>"
)


def joined_words(text: Column) -> Column:
    """Words of a text, joined by single spaces. Texts of ASCII only are lowered at once."""
    whole = F.coalesce(text, F.lit(""))
    plain = F.octet_length(whole) == F.length(whole)
    lowered = F.when(plain, F.lower(whole)).otherwise(F.translate(whole, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return F.trim(F.regexp_replace(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" ")))


def _stems_in(padded: Column) -> Column:
    """Distinct stems with which words of a text begin, found in one pass."""
    letters: dict[str, list[str]] = {}
    for stem in STEMS:
        letters.setdefault(stem[0], []).append(stem[1:])
    either = "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in letters.items())
    return F.array_distinct(F.regexp_extract_all(padded, F.lit(f"(?<= )(?:{either})"), F.lit(0)))


def _hits(padded: Column) -> Column:
    """Expressions with matches in a text, and these matches."""
    runs = F.from_json(F.lit(json.dumps(_runs())), _RUNS)

    def chosen(stem: Column) -> Column:
        groups = F.filter(runs, lambda g: (g["stem"] == stem) & F.contains(padded, g["keyword"]))
        return F.flatten(F.transform(groups, lambda g: g["rules"]))

    def run(rule: Column) -> Column:
        matches = F.regexp_extract_all(padded, rule["expression"], F.lit(0))
        return F.struct(rule["expression"].alias("expression"), rule["forms"].alias("forms"), matches.alias("matches"))

    every = F.flatten(F.transform(_stems_in(padded), chosen))
    return F.filter(F.transform(every, run), lambda h: F.size(h["matches"]) > 0)


def _spans_of(padded: Column, hit: Column) -> Column:
    """Word intervals of all matches of an expression: spaces are counted through the parts between matches."""
    parts = F.split(padded, hit["expression"])
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_EMPTY).alias("spans"))

    def form(match: Column) -> Column:
        return F.filter(hit["forms"], lambda f: F.exists(f["starts"], lambda s: F.startswith(match, s)))[0]

    def step(state: Column, pair: Column) -> Column:
        first = state["at"] + _spaces(pair["part"])
        last = first + _spaces(pair["match"])
        own = form(pair["match"])
        span = F.struct(
            (first - 1).alias("first"), (last - 1).alias("last"), own["label"].alias("label"),
            own["rule"].alias("rule"), own["priority"].alias("priority"), own["weight"].alias("weight"),
        )
        return F.struct(last.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    pairs = F.arrays_zip(F.slice(parts, 1, F.size(hit["matches"])).alias("part"), hit["matches"].alias("match"))
    return F.aggregate(pairs, start, step, lambda state: state["spans"])


def _kept(spans: Column) -> Column:
    """Spans not contained in one of the same or a higher priority: sorted by start, the furthest end per priority tells."""
    ordered = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["first"].alias("first"), (-s["last"]).alias("down"), (-s["priority"]).alias("rank"), s["rule"].alias("rule"), s.alias("span")
            ),
        )
    )
    levels = sorted({rule[4] for rule in rules()})
    start = F.struct(*(F.lit(-1).alias(f"end{p}") for p in levels), F.array().cast(_EMPTY).alias("kept"))

    def step(state: Column, item: Column) -> Column:
        span = item["span"]
        reach = F.greatest(*(F.when(span["priority"] <= p, state[f"end{p}"]).otherwise(-1) for p in levels))
        ends = (
            F.when(span["priority"] == p, F.greatest(state[f"end{p}"], span["last"])).otherwise(state[f"end{p}"]).alias(f"end{p}")
            for p in levels
        )
        kept = F.when(span["last"] <= reach, state["kept"]).otherwise(F.concat(state["kept"], F.array(span)))
        return F.struct(*ends, kept.alias("kept"))

    return F.filter(F.aggregate(ordered, start, step, lambda state: state["kept"]), lambda s: s["label"] != "")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words, base places, kept detections, labels and a score for every document; no shuffle."""
    words = docs.select(F.col(id_col), joined_words(F.col(text_col)).alias("_words"))
    padded = words.select(
        id_col,
        F.when(F.col("_words") == "", 0).otherwise(_spaces(F.col("_words")) + 1).cast("long").alias("n_words"),
        F.concat(F.lit(" "), F.col("_words"), F.lit(" ")).alias("_text"),
    )
    text = F.col("_text")
    gated = padded.withColumn("_hits", _hits(text))
    count, firsts, lasts, labels = [], [], [], []
    for k, (phrase, label) in enumerate(BASE):
        parts = F.when(text.contains(f" {phrase} "), F.split(text, f"(?<= ){re.escape(phrase).replace(chr(92) + ' ', ' ')}(?= )"))
        gated = gated.withColumn(f"_parts{k}", parts)
        parts = F.col(f"_parts{k}")
        count.append(F.coalesce(F.size(parts).cast("long") - 1, F.lit(0)))
        count[-1] = F.when(parts.isNull(), F.lit(0)).otherwise(F.size(parts) - 1).cast("long")
        firsts.append(_spaces(F.element_at(parts, 1)).cast("long") - 1)
        tail = _spaces(F.element_at(parts, -1)) + len(phrase.split()) - 1
        lasts.append((F.col("n_words") - tail).cast("long"))
        labels.append(F.when(parts.isNotNull(), F.lit(label)))
    spans = F.when(F.size("_hits") > 0, F.flatten(F.transform("_hits", lambda h: _spans_of(text, h))))
    found = gated.withColumn("_spans", spans).withColumn(
        "detections", F.when(F.size(F.coalesce(F.col("_spans"), F.array())) > 0, _kept(F.col("_spans"))).otherwise(F.array().cast(_EMPTY))
    )
    base = F.array_sort(F.array_distinct(F.array_compact(F.array(*labels))))
    named = F.array_sort(F.array_distinct(F.concat(F.col("base_list"), F.transform("detections", lambda d: d["label"]))))
    weight = F.coalesce(F.array_max(F.transform("detections", lambda d: d["weight"])), F.lit(0.0))
    return found.select(
        id_col, "n_words", sum(count[1:], count[0]).alias("n_base"), F.least(*firsts).alias("first_word"),
        F.greatest(*lasts).alias("last_word"), base.alias("base_list"), "detections",
    ).select(
        id_col, "n_words", "n_base", "first_word", "last_word", "base_list", named.alias("label_list"), "detections",
        F.greatest(weight, F.when(F.size("base_list") > 0, 0.6).otherwise(0.0)).alias("score"),
    )
