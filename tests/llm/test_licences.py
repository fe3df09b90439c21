from __future__ import annotations

import duckdb
import pytest

from tidemark.llm import licences as lc

GRANT, CONDITION, AS_IS = (lc.SENTENCES[n][0] for n in ("mit-grant", "mit-condition", "as-is"))
MIT = f"MIT License\n\nCopyright (c) 2020 X\n\n{GRANT}:\n\n{CONDITION}.\n\n{AS_IS}.".replace(" copies of", "\ncopies of")
BSD = "\n".join(["Some program.", lc.SENTENCES["bsd-grant"][0] + ":", "1. " + lc.SENTENCES["bsd-source"][0] + ".",
                 "2. " + lc.SENTENCES["bsd-binary"][0] + "."])


def bsd(who, names):
    return f"Copyright (c) 2001 {who}.\n{BSD}\n3. {names.format(who)}."


def notice(licence, version, end, mark):
    return (f"Foo is free software{';' if mark == ';' else ':'} you can redistribute it and/or modify\nit under the terms of "
            f"the {licence} as published by\nthe Free Software Foundation{mark} {'either ' if end else ''}version {version} of the "
            f"License{end}.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; x")


CASES = [
    (MIT, "MIT"),
    (BSD, "BSD-2-Clause"),
    (f"{BSD}\n3. {lc.SENTENCES['bsd-names'][0]}.", "BSD-3-Clause"),
    ("// Licensed under the Apache License, Version 2.0 (the \"License\");\n// you may not use this file except in\n"
     "// compliance with the License.", "Apache-2.0"),
    ("Text. RELEASED under the  MIT\nLicence! More", "MIT"),
    ("Licensed under CC BY-NC 4.0.\nWords", "CC-BY-NC-4.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0-only"),
    ("All rights reserved.\nReleased under the MIT License.", "MIT"),
    ("all rights reserved", "all-rights-reserved"),
    (f"{CONDITION}.", None),
    (f"{CONDITION}. {GRANT}.", None),
    ("We talk about licensed plumbers. Not all rights reserved here.", None),
    *((bsd(who, names), name) for who in ("the University", "Example Corp., Inc", "its authors") for names, name in (
        ("Neither the name of {0} nor the names of its contributors may be used to endorse or promote products derived "
         "from this software without specific prior written permission", "BSD-3-Clause"),
        ("The names of {0} may not be used to endorse or promote products derived from this software without specific "
         "prior written permission", "BSD-3-Clause"),
        ("All advertising materials mentioning features or use of this software must display the following "
         "acknowledgement: This product includes software developed by {0}", "BSD-4-Clause"),
        ("Products derived from this software may not be called by the name of {0}", None))),
    *((notice(f"{word} General Public License", version, end, mark), f"{kind}-{spdx}{name}")
      for word, kind in (("GNU", "GPL"), ("GNU Lesser", "LGPL"), ("GNU Affero", "AGPL"))
      for version, spdx in (("2", "2.0"), ("2.1", "2.1"), ("3", "3.0"))
      for end, name in ((", or\n(at your option) any later version", "-or-later"), ("", "-only")) for mark in ";,"),
    (notice("GNU Library General Public License", "2", ", or (at your option) any later version", ";"), "LGPL-2.0-or-later"),
    ("/*\n * This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the "
     "MPL was not distributed\n */", "MPL-2.0"),
    *((f"Copyright 2019 X.\n\nThis program and the accompanying materials are made available under the\nterms of the "
       f"Eclipse Public License {v} which is available at\nhttps://x.example/epl.", f"EPL-{n}")
      for v, n in (("2.0", "2.0"), ("v. 2.0", "2.0"), ("v2.0", "2.0"), ("v1.0", "1.0"), ("Version 1.0", "1.0"))),
    ("This software is provided 'as-is', without any express or implied\nwarranty.\n\n" + lc.SENTENCES["zlib-grant"][0] +
     ":\n\n1. The origin of this software must not be misrepresented", "Zlib"),
    ("Boost Software License - Version 1.0 - August 17th, 2003\n\n" + lc.SENTENCES["bsl-grant"][0] + ":", "BSL-1.0"),
    ("// Distributed under the Boost Software License, Version 1.0. (See accompanying file)", "BSL-1.0"),
    ("This is free software; you can redistribute it and/or modify it under\nthe terms of the Artistic License 2.0.", "Artistic-2.0"),
    (f"{GRANT}:\n\n{CONDITION}.\n\nThe Software shall be used for Good, not Evil.\n\n{AS_IS}.", "JSON"),
    (f"{BSD}\n\nTHIS SOFTWARE IS PROVIDED BY X \"AS IS\" AND ANY WARRANTIES ARE DISCLAIMED. IN NO EVENT SHALL X BE LIABLE FOR "
     "DAMAGES ARISING OUT OF THE USE OF THIS SOFTWARE.", "BSD-2-Clause"),
    ("You may use this software and you must like it.", None),
    ("The Mozilla Public License, v. 2.0, is one of many; (v. 3) v.9 xv. 2", None),
    ("licen", None), ("", None), (None, None), (" \n\n ", None),
    ("word " * 50_000 + ". Released under the MIT License.", "MIT"),
]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, t, "x") for i, (t, _) in enumerate([*CASES, *CASES[:2]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    return rows, lc.licensed(docs)


def test_licences(found):
    _, df = found
    by_id = {r.doc_id: r for r in df.collect()}
    assert df.columns == ["doc_id", "text", "license", "license_sentences", "n_license_sentences"]
    assert [by_id[i].license for i in range(len(CASES))] == [name for _, name in CASES]
    assert by_id[0].n_license_sentences == 4 and by_id[len(CASES)].license == "MIT"
    by_text = {r.text: r for r in by_id.values()}
    for text in ("", "You may use this software and you must like it."):
        assert (by_text[text].license_sentences, by_text[text].n_license_sentences) == ("|", 0)
    assert all(name in {n for n, _ in lc.RULES} for _, name in CASES if name)


def test_sql_gives_the_same(found):
    rows, df = found
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    expected = con.execute(lc.oracle()).fetchall()
    actual = df.select("doc_id", "license", "license_sentences", "n_license_sentences").collect()
    assert sorted(map(tuple, actual)) == sorted(expected)


def test_no_rows_and_no_python(spark, found):
    _, df = found
    assert df.limit(0).count() == 0
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in df.select("license")._jdf.queryExecution().executedPlan().toString()


def test_every_sentence_has_a_trigger_and_every_rule_its_sentences():
    known = lc.known_sentences()
    assert all(any(t in s for t in lc.TRIGGERS) for s in known)
    assert {n for _, rule in lc.RULES for n in rule} == set(known.values())
