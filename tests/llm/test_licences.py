from __future__ import annotations

import random

import duckdb
from casework.llm import licences

from .conftest import doc_rows

MIT = next(s for s, i in licences.SENTENCES.items() if i == "mit-grant")
CONDITION = next(s for s, i in licences.SENTENCES.items() if i == "mit-condition")


def brute(text):
    import re

    ids = []
    for s in re.split(r"[\n\r]+", re.sub(r"([.!?;:])[ \t]+", r"\1\n", (text or "").lower())):
        known = licences.SENTENCES.get(re.sub(r"[^a-z0-9]+", " ", s).strip(" "))
        ids += [known] if known else []
    rest, found = list(ids), []
    for name, kind, rule in licences.RULES:
        at, hit = 0, False
        while at + len(rule) <= len(rest):
            if tuple(rest[at : at + len(rule)]) == rule:
                rest[at : at + len(rule)] = [None]
                hit = True
            else:
                at += 1
        if hit:
            found.append((name, kind))
    kinds = {k for _, k in found}
    return " ".join(ids), " ".join(sorted({n for n, _ in found})), next((c for c in licences.CLASSES if c in kinds), "none")


def test_equals_brute_force_and_sql(some_docs):
    texts = [
        "Released under the MIT License.",
        "Some prose. Licensed under the Apache License, Version 2.0.\nMore prose.",
        f"{MIT}: {CONDITION}.",
        f"{CONDITION}. {MIT}.",
        "The MIT License (MIT)\n\n" + MIT.upper() + ":\n" + CONDITION + ".",
        "Licensed under CC BY-NC 4.0. All rights reserved! Released under the MIT License.",
        "This is released under the MIT License elsewhere.",
        "mit license\r\nMIT License; mit license",
        "",
        None,
        "word " * 20_000 + "\nLicensed under CC0 1.0.",
    ]
    rows = list(enumerate(texts))
    frame = some_docs(rows)
    got = {r.doc_id: (r.sentence_ids, r.licences, r.licence_class) for r in licences.licences(frame).collect()}
    assert got == {d: brute(t) for d, t in rows}
    assert got[2][1] == "MIT" and got[3][1] == "MIT" and got[5][2] == "restricted" and got[6][2] == "none"
    con = duckdb.connect()
    documents = frame.toPandas()  # noqa: F841
    same = con.sql(licences.licences_sql()).fetchall()
    assert {r[0]: r[1:] for r in same} == got


def test_edge_rows(docs, no_docs):
    assert licences.licences(docs).count() == len(doc_rows())
    assert licences.licences(no_docs).count() == 0


HEADERS = {
    "MIT": """Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
""",
    "BSD-3-Clause": """Copyright (c) 2020, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.
""",
}


def test_wrapped_headers(some_docs):
    prefixes = ["", "# ", " * ", "// "]
    rows = [(n, p + h.replace("\n", "\n" + p)) for n, (h, p) in enumerate((h, p) for h in HEADERS.values() for p in prefixes)]
    got = {r.doc_id: (r.licences, r.licence_class) for r in licences.licences(some_docs(rows)).collect()}
    kinds = {n: c for n, c, _ in licences.RULES}
    want = [(name, kinds[name]) for name in HEADERS for _ in prefixes]
    assert [got[n] for n in range(len(want))] == want


def test_blank_lines_and_stops_cut(some_docs):
    rows = [(0, "Licensed under the\n\nMIT License."), (1, "Licensed under. The ISC license"), (2, "All rights reserved.\nSome prose.")]
    got = {r.doc_id: r.licences for r in licences.licences(some_docs(rows)).collect()}
    assert got == {0: "MIT", 1: "", 2: "All-rights-reserved"}


def test_sql_equals_on_wrapped_texts(some_docs):
    """Sentences wrapped anywhere, with marks, blank lines, headed grants and stray cuts between them."""
    rng = random.Random(21)
    sentences = list(licences.SENTENCES)
    texts = ["# " + h.replace("\n", "\n# ") for h in HEADERS.values()] + list(HEADERS.values())
    texts += ["All rights reserved.\n" + h for h in HEADERS.values()] + ["", None, "|", "\n\n", ".", "\r\n \r\n"]
    for _ in range(300):
        parts = []
        for _ in range(rng.randint(1, 5)):
            words = rng.choice(sentences).split() if rng.random() < 0.8 else ["some", "prose"]
            parts += [w + rng.choice([" "] * 12 + ["\n", "\n * ", "\r\n", "\n\n", " | ", "-", ";"]) for w in words[:-1]]
            parts += [words[-1], rng.choice([". ", ".\n", "\n", "\n\n", "\n # \n", "; ", ": 2. ", "! ", ".! ", " . 1", "|", " "])]
        texts.append("".join(parts))
    frame = some_docs(list(enumerate(texts)))
    got = {r.doc_id: (r.sentence_ids, r.licences, r.licence_class) for r in licences.licences(frame).collect()}
    documents = frame.toPandas()  # noqa: F841
    same = {r[0]: r[1:] for r in duckdb.connect().sql(licences.licences_sql()).fetchall()}
    assert {d: (texts[d], got[d], same[d]) for d in got if got[d] != same[d]} == {}
    assert len({v[1] for v in got.values()}) > 10
