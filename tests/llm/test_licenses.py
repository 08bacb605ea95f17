import hashlib
import os
import random
import re
import textwrap
from importlib import resources

import pytest
from check import assert_same, connect
from conftest import rows_of

from asterism.llm import licenses
from asterism.llm.license_texts import TEXTS
from asterism.llm.queries import ORACLES, QUERIES, license_sql

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
MIT = TEXTS["MIT"][0]
VARIANTS = [
    MIT,
    MIT.upper(),
    MIT.replace("\n", "  \n\t").replace('"', "“"),
    "Copyright (c) 2020 Some One\n" + MIT + "\n© 2021 Another, Inc. All rights reserved\n",
    "\n\n" + MIT.replace("License", "Licence").replace("sublicense", "sub-license"),
]


FILES = {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in resources.files("asterism.llm").joinpath("license_files").iterdir()}
WHOLE = FILES | {"MIT": MIT, "ISC": TEXTS["ISC"][0], "Zlib": TEXTS["Zlib"][0]}
OWN_NOTICE = re.compile(r"\s*(copyright\s*(\(c\)|[\[<{(]?(\d{4}|yyyy))|\(c\)\s*\d{4})", re.I)


def canonical_text(text):
    """The canonical form in Python."""
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    for other, ours in licenses.SPELLINGS:
        text = text.replace(other, ours)
    lines = [re.sub(licenses.DECORATION, "", line) for line in text.split("\n")]
    lines = ["\n" if re.search(licenses.COPYRIGHT_LINE, x) or not re.search(licenses.WORDS, x) else x for x in lines]
    parts = []
    for part in re.split(licenses.BREAK, " ".join(lines)):
        part = re.sub(licenses.PUNCTUATION, " ", re.sub(licenses.ITEM, r"\1", part.strip(" "))).strip(" ")
        for other, ours in licenses.PHRASES:
            part = part.replace(other, ours)
        parts.append(part)
    return " ".join(filter(None, parts))


def refilled(text, width):
    """The paragraphs wrapped anew, but for copyright lines, which stay as they are."""
    out, held = [], []
    for line in [*text.split("\n"), ""]:
        if line.strip() and not OWN_NOTICE.match(line):
            held.append(line.strip())
            continue
        if held:
            out.append(textwrap.fill(" ".join(held), width, break_long_words=False, break_on_hyphens=False))
            held = []
        out.append(line)
    return "\n".join(out)


def commented(text, first, each, last):
    return "\n".join([first, *(f"{each}{line}" for line in text.split("\n")), last])


FORMS = {
    "as it is": lambda t: t,
    **{f"{w} columns": (lambda t, w=w: refilled(t, w)) for w in (60, 72, 100)},
    "a line a paragraph": lambda t: refilled(t, 1 << 20),
    "in C": lambda t: commented(t, "/*", " * ", " */"),
    "in a script, wrapped": lambda t: commented(refilled(t, 64), "#!/bin/sh", "# ", "#").removeprefix("#!/bin/sh"),
    "in Java": lambda t: commented(t, "//", "//   ", "//"),
    "bullets": lambda t: re.sub(r"(?m)(^\s*\n|[.;:]\s*\n)(\s*)\(?([0-9]{1,2}|[a-z])[.)]\s", r"\1\2* ", t),
    "shouted, with an owner": lambda t: "Copyright (c) 2021 Some One\n\n" + t.upper(),
}


def test_known_texts_in_any_form(documents):
    """Each whole text is found however it is wrapped, commented or numbered."""
    cases = [(name, form) for name in WHOLE for form in FORMS]
    rows = [(i, FORMS[form](WHOLE[name])) for i, (name, form) in enumerate(cases)]
    got = {r["doc_id"]: r["license"] for r in licenses.license_scan(documents(rows)).collect()}
    assert [(n, f, got[i]) for i, (n, f) in enumerate(cases) if got[i] != n] == []


def test_copyright_lines_joined_to_others(documents):
    """A line that was joined to its neighbours isn't left out, so the form that keeps them is looked up."""
    text = re.sub(r"(?<=\S)\n(?=[ \t]*\S)", " ", WHOLE["GPL-2.0"])
    assert licenses.license_scan(documents([(1, text)])).first()["license"] == "GPL-2.0"


def test_versions_are_no_list_items(documents):
    rows = [(i, f"This is licensed under the GNU General Public License, v. {i}.0. That is all.") for i in (1, 2, 3)]
    assert len({r["digest"] for r in licenses.license_scan(documents(rows)).collect()}) == 3


def test_spellings(documents):
    one = "The licence was authorised whilst the copyright owner labelled 5 per cent of the programme non-commercial."
    other = "The license was authorized while the copyright holder labelled 5 percent of the program noncommercial."
    rows = licenses.license_scan(documents([(1, one), (2, other), (3, other.replace("5", "6"))])).collect()
    digests = {r["doc_id"]: r["digest"] for r in rows}
    assert digests[1] == digests[2] != digests[3]


def test_sql_on_licences(spark, documents, tmp_path):
    """Paragraphs, notices and whole texts, with digests that the SQL makes itself."""
    rows = [(i, FORMS[form](WHOLE[name])) for i, (name, form) in enumerate([(n, f) for n in ("MIT", "BSD-3-Clause", "GPL-2.0") for f in FORMS])]
    rows += [(100, f"some words\n\n{MIT}\n\nmore words"), (101, "\n".join(t for of in TEXTS.values() for t in of if len(t) < 300))]
    rows += [(102, None), (103, ""), (104, "/* SPDX-License-Identifier: GPL-2.0+ */\n\n" + TEXTS["Apache-2.0"][-1])]
    documents(rows).write.parquet(str(tmp_path / "d"))
    table = spark.read.parquet(str(tmp_path / "d"))
    sql = license_sql(docs=f"read_parquet('{tmp_path}/d/*.parquet')")
    assert assert_same(licenses.license_scan(table), connect(SF_DIR), sql) == len(rows)


def test_a_large_table_of_texts_gives_the_same(documents, monkeypatch):
    docs = documents([*enumerate([*WHOLE.values(), "none", None, "x\n\nReleased under the MIT License"])])
    want = rows_of(licenses.license_scan(docs))
    monkeypatch.setattr(licenses, "BROADCAST_LIMIT", 10)
    assert rows_of(licenses.license_scan(docs)) == want


def test_variants_have_one_digest(documents):
    rows = licenses.license_scan(documents([*enumerate(VARIANTS)])).collect()
    assert {r["license"] for r in rows} == {"MIT"}
    assert len({r["digest"] for r in rows}) == 1


def test_other_texts_are_no_licence(documents):
    cut = MIT.replace("free of charge", "at a charge")
    rows = licenses.license_scan(documents([(1, cut), (2, "Copyright 2020 me"), (3, MIT + "more")])).collect()
    assert {r["license"] for r in rows} == {None}


def test_notices(documents):
    text = "Some words.\nReleased under the MIT Licence\nmore words\n * SPDX-License-Identifier:  ISC\nreleased under the mit license."
    row = licenses.license_scan(documents([(1, text)])).first()
    assert (row["license"], row["notices"]) == (None, "ISC,MIT")


def test_both_forms_of_the_canonical_text_agree(documents):
    texts = [*VARIANTS, "Ünïcode — “quotes” … İ\n\x00\x7f(c) gone\nEND", "", *(t for of in TEXTS.values() for t in of)]
    got = {r["doc_id"]: r["digest"] for r in licenses.license_scan(documents([*enumerate(texts)])).collect()}
    for i, text in enumerate(texts):
        assert got[i] == hashlib.md5(canonical_text(text).encode()).hexdigest()


def test_oracle(spark):
    name = "op8_license_scan"
    assert assert_same(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) > 0


def test_odd_rows(messy):
    rows = licenses.license_scan(messy)
    assert rows.count() == messy.count()
    empty = hashlib.md5(b"").hexdigest()
    assert sum(r[1] == empty for r in rows_of(rows)) == 3
    assert licenses.license_scan(messy.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "BSD-3-Clause", "Unlicense"])
def test_whole_texts_of_usual_licences(documents, name):
    text = resources.files("asterism.llm").joinpath(f"license_files/{name}.txt").read_text()
    assert licenses.license_scan(documents([(1, "Copyright (c) 2020 me\n\n" + text.upper())])).first()["license"] == name


def test_notices_of_several_lines(documents):
    gpl = """/*
 * Copyright (C) 2020 Some One
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * more words
 */"""
    apache = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
x = 1"""
    rows = licenses.license_scan(documents([(1, gpl), (2, apache), (3, f"{apache}\n\n{gpl}"), (4, gpl[:200])])).collect()
    assert {r["doc_id"]: r["notices"] for r in rows} == {1: "GPL-3.0", 2: "Apache-2.0", 3: "Apache-2.0,GPL-3.0", 4: ""}


def test_known_texts_from_a_table(spark, documents):
    table = spark.createDataFrame([("Ours", "You may\nread this."), ("Ours", "Read on."), (None, "x"), ("y", None)], "name string, text string")
    rows = licenses.license_scan(documents([(1, "you may read this"), (2, "a\n\nYou may\nread this\n\nb"), (3, MIT)]), table)
    got = {r["doc_id"]: (r["license"], r["notices"]) for r in rows.collect()}
    assert got == {1: ("Ours", "Ours"), 2: (None, "Ours"), 3: (None, "")}


def test_lines_are_asked_once_for_owners_and_respelled_where_needed(documents):
    """The costly patterns see each line once, and replacements only texts that hold a spelling."""
    plan = licenses.forms(documents([(1, MIT)]), "doc_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(licenses.COPYRIGHT_LINE) == 1
    assert re.search(r"RLIKE\([^\n]*?acknowledgement[^\n]*? THEN (replace\()+", plan)
    assert plan.count(licenses.ITEM) == plan.count(f"{licenses.ITEM_END}) THEN regexp_replace")


def test_spellings_are_told_exactly(spark):
    words = [other for other, _ in licenses.SPELLINGS + licenses.PHRASES]
    texts = [*words, *(f"xx{w}\n{w}" for w in words), *(w[:-1] for w in words), *(w[1:] for w in words), "", "kgyfubcpv:ljxmw"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for pairs in (licenses.SPELLINGS, licenses.PHRASES):
        others = [other for other, _ in pairs]
        got = rows.select("text", rows.text.rlike(licenses._any_of(others)).alias("found")).collect()
        assert [r for r in got if r["found"] != any(o in r["text"] for o in others)] == []


def test_mixed_texts_have_the_plain_canonical_form(documents):
    """Items, signs and spellings in any order, within and across lines."""
    pieces = [other for other, _ in licenses.SPELLINGS + licenses.PHRASES]
    pieces += ["word", "non", "commercial", "éö", "x", "end;", "end.", 'so":', "and", "or", "copyright", "2020", "©"]
    pieces += ["a)", "(b)", "[c]", "1.", "1.2.3.", "iv.)", "xiii:", "12", "123.", "é.", "“", "”;", "—", "…", "\t", "*", "--", "A.", "I)"]
    draw = random.Random(8)
    texts = ["".join(draw.choice(pieces) + draw.choice(["", " ", " ", " ", "  ", "\n", "\n\n", " \n* "]) for _ in range(30)) for _ in range(400)]
    got = {r["doc_id"]: r["digest"] for r in licenses.license_scan(documents([*enumerate(texts)])).collect()}
    wrong = [t for i, t in enumerate(texts) if got[i] != hashlib.md5(canonical_text(t).encode()).hexdigest()]
    assert wrong == []
