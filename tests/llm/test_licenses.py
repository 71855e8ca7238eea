"""Licence scan against a plain scan of the same rules."""

import re

from tallyloom.llm import licenses

TEXTS = [
    None, "", "...", "mit", "MIT License", "the mit-license, and MIT LICENSE again", "Licensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "cc bye cc by", "submit license mit licenses",
    "cc by cc by cc by", "see the GNU Lesser General Public License v 2.1 or the gnu general public license", "émit license mit licenseé mit license",
    "Copyright 2020 Some Body All rights reserved", "placed in the public domain", "SPDX-License-Identifier: Apache License 2.0 cc0",
    "x " * 20000 + "released under the MIT License. " * 60 + "y", "apache\nlicense\x00apache\tLICENSE İMIT LICENSE",
    "under the terms of the Mozilla Public License 2.0, the BSD 3-Clause License and the Artistic License",
]


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text):
    w = words(text)
    joined = " " + " ".join(w) + " "
    places, base = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    spans = []
    if any(" " + s in joined for s in licenses.STEMS):
        for i, label, keyword, expression, priority, weight in licenses.rules():
            if keyword in joined:
                for m in re.finditer(expression, joined):
                    first = joined[: m.start()].count(" ") - 1
                    spans.append((first, first + m[0].count(" "), label, i, priority, weight))
    kept = []
    for k, s in enumerate(spans):
        beaten = any(
            t[0] <= s[0] and s[1] <= t[1] and t[4] >= s[4] and (t[:2] != s[:2] or (-t[4], t[3]) < (-s[4], s[3]))
            for j, t in enumerate(spans) if j != k
        )
        if not beaten and s[2]:
            kept.append(s)
    score = max([s[5] for s in kept] + [0.6 if base else 0.0])
    return (len(w), len(places), min(places, default=None), max(places, default=None), sorted(base), sorted(base | {s[2] for s in kept}), sorted(kept), score)


def test_scan_agrees_with_a_plain_scan(spark):
    assert len(licenses.rules()) >= 200
    docs = spark.createDataFrame([(i, t, "z", 3) for i, t in enumerate(TEXTS)], "doc_id long, text string, labels string, n_words int")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert (
            r.n_words, r.n_base, r.first_word, r.last_word, r.base_list, r.label_list, sorted(tuple(d) for d in r.detections), r.score
        ) == brute(t), repr(t)[:80]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_labels_of_headers(spark):
    texts = ["Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "Released under the MIT License.", "no terms here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.label_list for r in licenses.scan(docs).orderBy("doc_id").collect()]
    assert got == [["apache", "apache-2.0"], ["cc-by", "cc-by-nc"], ["mit"], []]


NAMED = [
    ("This code is released under the WTFPL.", ["wtfpl"]), ("Released under CC0 1.0.", ["cc0"]), ("Licensed under AGPLv3", ["agpl-3.0"]),
    ("the AGPL v3", ["agpl-3.0"]), ("Creative Commons Attribution-ShareAlike 4.0", ["cc-by-sa"]), ("Creative Commons Attribution 4.0", ["cc-by-4.0"]),
    ("Creative Commons Attribution-NonCommercial 3.0", ["cc-by-nc"]), ("Creative Commons Attribution No Derivatives", ["cc-by-nd"]),
    ("Released under the GPLv2.", ["gpl-2.0"]), ("GPL-3.0", ["gpl-3.0"]), ("distributed under GPL v3 or later", ["gpl-3.0"]),
    ("Licensed under LGPL v2.1", ["lgpl-2.1"]), ("Apache-2.0", ["apache-2.0"]), ("GNU GPL", ["gpl"]), ("MPL 2.0", ["mpl-2.0"]), ("CDDL", ["cddl"]),
    ("EPL-2.0 or LGPL-2.1", ["epl-2.0", "lgpl-2.1"]), ("GPLv3+", ["gpl-3.0"]), ("BSD licence 3-Clause", ["bsd-3-clause"]), ("a 3-clause BSD licence", ["bsd-3-clause"]),
    ("available under MIT or Apache", ["mit"]), ("he read the EPL table at MIT", []), ("we are not licensed under the Mozilla Public License 2.0", []),
    ("we are not licensed under the MIT License", ["mit"]), ("not released under GPLv2, but under the terms of the EUPL 1.2", ["eupl"]),
    ("Creative Commons Attribution-NonCommercial-NoDerivs", ["cc-by-nc-nd"]), ("CC Attribution Share Alike", ["cc-by-sa"]),
]


def samples(expression):
    """Strings that an expression matches, with every alternative in it, an optional part left out and put in."""
    def of(parts):
        out = [""]
        for op, value in parts:
            name = str(op)
            if name == "LITERAL":
                more = [chr(value)]
            elif name == "IN":
                more = ["7" if str(kind) == "CATEGORY" else "z" if str(kind) == "NEGATE" else chr(v) for kind, v in value[:2] if str(kind) != "RANGE"][:1]
            elif name == "NOT_LITERAL":
                more = ["z"]
            elif name == "MAX_REPEAT":
                more = sorted({x * n for x in of(value[2]) for n in {value[0], min(value[1], max(value[0], 1))}})
            elif name == "SUBPATTERN":
                more = of(value[3])
            elif name == "BRANCH":
                more = [x for branch in value[1] for x in of(branch)]
            else:
                assert name == "ASSERT", name
                more = [""]
            out = [a + b for a in out for b in more]
        return out

    return of(re._parser.parse(expression))


def test_gates_hold_for_all_that_rules_match():
    for _, label, keyword, expression, _, _ in licenses.rules():
        for sample in samples(expression):
            text = f" {sample} "
            assert re.search(expression, text), (expression, sample)
            assert keyword in text, (label, keyword, sample)
            assert any(" " + s in text for s in licenses.STEMS if licenses._stem(keyword).startswith(s)), (label, sample)


def test_scan_agrees_with_a_plain_scan_without_gates(spark, monkeypatch):
    short = [t for t in TEXTS if len(t or "") < 1000]
    texts = short + [t for t, _ in NAMED] + [samples(rule[3])[-1] for rule in licenses.rules()[4::5]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.label_list, sorted(tuple(d) for d in r.detections), r.score) for r in licenses.scan(docs).collect()}
    rules = [(i, label, "", re.compile(expression), *rest) for i, label, _, expression, *rest in licenses.rules()]
    monkeypatch.setattr(licenses, "rules", lambda: rules)
    monkeypatch.setattr(licenses, "STEMS", ("",))
    for i, t in enumerate(texts):
        assert got[i] == brute(t)[5:], repr(t)[:80]
    for i, (_, labels) in enumerate(NAMED, len(short)):
        assert got[i][0] == labels, texts[i]


def test_labels_of_spdx_identifiers_and_licence_texts(spark):
    spdx, mit = "// SPDX-License-Identifier: ", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    texts = [
        (spdx + "MIT", ["mit"]), (spdx + "Apache-2.0", ["apache-2.0"]), (spdx + "BSD-3-Clause", ["bsd-3-clause"]), (spdx + "GPL-2.0-only", ["gpl-2.0"]),
        (spdx + "MIT-0", ["mit-0"]), (spdx + "GPL-2.0-or-later WITH Classpath-exception-2.0 OR (MIT AND ISC)", ["gpl-2.0", "isc", "mit"]),
        (spdx + "foo. Permit", []), (mit + '"Software"), to deal in the Software without restriction', ["mit"]),
        (mit + '"Software"), to deal with the Software without restriction', ["ncsa"]),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted. Neither the name of Some Body nor the names of "
         "its contributors may be used to endorse or promote products derived from this software", ["bsd", "bsd-3-clause"]),
        ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that", ["isc"]),
        ("This is free and unencumbered software released into the public domain.", ["unlicense"]),
    ]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.label_list, sorted(tuple(d) for d in r.detections)) for r in licenses.scan(docs).collect()}
    for i, (t, labels) in enumerate(texts):
        assert got[i] == (labels, brute(t)[6]), t
