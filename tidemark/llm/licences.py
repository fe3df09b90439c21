"""Licences in texts, by known sentences and ordered rules.

A text is cut into sentences twice: paragraph by paragraph with wrapped lines joined, and
line by line. Sentences are written small with single spaces for all that is no letter or
digit and looked up among the known ones; those with a gap for names or versions are brought to one
form first. The identifiers found, in order, are the text's two sequences, in which ``!`` stands for an
unknown sentence on what may or must be done with "this software". A rule is a list of identifiers that must
follow each other in a sequence, others between them allowed. In a rule of ``STRICT`` licences, which differ
by their number of conditions, no ``!`` may stand between or after them. The first rule that holds names the licence.

Defined results: null and empty texts and texts without a known sentence have no licence
(null), an empty sequence and 0 sentences; known sentences that complete no rule give a
sequence without a licence; repeated rows are alike; extra columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and notices, by identifier.
SENTENCES = {
    "mit-title": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "mit-notice": ["Released under the MIT License", "Licensed under the MIT License", "Licensed under MIT",
                   "This project is licensed under the MIT License", "License: MIT"],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                  "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                  "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                  "furnished to do so, subject to the following conditions"],
    "mit-condition": ["The above copyright notice and this permission notice shall be included in all copies or "
                      "substantial portions of the Software"],
    "isc-title": ["ISC License"],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                  "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
                  "in all copies"],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted "
                  "provided that the following conditions are met"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions "
                   "and the following disclaimer"],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
                   "and the following disclaimer in the documentation and/or other materials provided with the "
                   "distribution"],
    "bsd-names": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                  "or promote products derived from this software without specific prior written permission"],
    "bsd-advertising": ["All advertising materials mentioning features or use of this software must display the "
                        "following acknowledgement"],
    "bsd-2-notice": ["Licensed under the BSD 2-Clause License"],
    "bsd-3-notice": ["Licensed under the BSD 3-Clause License", "Released under the BSD License",
                     "Licensed under the BSD License"],
    "apache-notice": ["Licensed under the Apache License, Version 2.0",
                      "Licensed under the Apache License, Version 2.0 (the \"License\")",
                      "Released under the Apache License, Version 2.0", "Licensed under Apache-2.0"],
    "apache-use": ["you may not use this file except in compliance with the License"],
    "apache-basis": ["Unless required by applicable law or agreed to in writing, software distributed under the "
                     "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                     "either express or implied"],
    "gpl-2-notice": ["This work is licensed under the GNU General Public License, version 2",
                     "Licensed under the GNU General Public License, version 2"],
    "gpl-3-notice": ["This work is licensed under the GNU General Public License, version 3",
                     "Licensed under the GNU General Public License, version 3"],
    "gnu-gpl-terms": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                      "published by the Free Software Foundation"],
    "gnu-lgpl-terms": ["you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                       "License as published by the Free Software Foundation",
                       "you can redistribute it and/or modify it under the terms of the GNU Library General Public "
                       "License as published by the Free Software Foundation"],
    "gnu-agpl-terms": ["you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
                       "License as published by the Free Software Foundation"],
    "gpl-hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"],
    "lgpl-notice": ["Licensed under the GNU Lesser General Public License, version 3",
                    "This work is licensed under the GNU Lesser General Public License, version 3"],
    "agpl-notice": ["Licensed under the GNU Affero General Public License, version 3",
                    "This work is licensed under the GNU Affero General Public License, version 3"],
    "mpl-notice": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
                   "Licensed under the Mozilla Public License, Version 2.0"],
    "epl-1-notice": ["Licensed under the Eclipse Public License 1.0", "Licensed under the Eclipse Public License v1.0"],
    "epl-2-notice": ["Licensed under the Eclipse Public License 2.0", "Licensed under the Eclipse Public License v2.0"],
    "zlib-grant": ["Permission is granted to anyone to use this software for any purpose, including commercial "
                   "applications, and to alter it and redistribute it freely, subject to the following restrictions"],
    "zlib-notice": ["Licensed under the zlib License", "Released under the zlib License"],
    "bsl-grant": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
                  "software and accompanying documentation covered by this license (the \"Software\") to use, "
                  "reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works "
                  "of the Software, and to permit third-parties to whom the Software is furnished to do so, all "
                  "subject to the following"],
    "bsl-notice": ["Distributed under the Boost Software License, Version 1.0",
                   "Licensed under the Boost Software License, Version 1.0"],
    "artistic-title": ["The Artistic License 2.0", "Artistic License 2.0"],
    "artistic-notice": ["Licensed under the Artistic License 2.0",
                        "you can redistribute it and/or modify it under the terms of the Artistic License 2.0"],
    "json-good": ["The Software shall be used for Good, not Evil"],
    "unlicense-title": ["This is free and unencumbered software released into the public domain"],
    "public-domain": ["This work is dedicated to the public domain", "Released into the public domain",
                      "This work is in the public domain and free of any license"],
    "as-is": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
              "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"],
    "reserved": ["All rights reserved"],
}
# Creative Commons licences, by their letters, and SPDX identifiers.
CC_KINDS = ["BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"]
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
CC_PHRASES = ["Licensed under CC {0}", "This work is licensed under CC {0}", "Released under CC {0}"]
SPDX = ["MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-3.0-only",
        "AGPL-3.0-only", "MPL-2.0", "Unlicense", "CC0-1.0", "GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-2.1-only",
        "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later", "EPL-1.0", "EPL-2.0", "Zlib", "BSL-1.0",
        "BSD-4-Clause", "Artistic-2.0", "JSON"]
# GNU licences by the word in their names, their versions, and how notices end.
GNU = {"": "gpl", "lesser ": "lgpl", "library ": "lgpl", "affero ": "agpl"}
GNU_VERSIONS = {"2": "2.0", "2.1": "2.1", "3": "3.0"}
GNU_ENDS = {"-or-later": " or at your option any later version", "-only": ""}
GNU_NOTICE = "gnu {0}general public license version {1}{2}"


def normal(sentence: str) -> str:
    small = re.sub(VERSION, r"\1v\2", sentence.lower())
    return re.sub("[^a-z0-9]+", " ", small).strip().replace("licence", "license")


#: "v. 2.0" is one word of a sentence, not its end.
VERSION = "(^|[ (,])v[.]? ?([0-9])"
NO_ENDORSING = "may{0} be used to endorse or promote products derived from this software without specific prior written permission$"
#: Sentences with a gap: a pattern of the normal sentence and the form it is brought to.
GAPS = [
    ("^neither the names? of .+ nor the names of (?:its|their|the|any) contributors " + NO_ENDORSING.format(""),
     normal(SENTENCES["bsd-names"][0])),
    ("^the names? of .+ " + NO_ENDORSING.format(" not"), normal(SENTENCES["bsd-names"][0])),
    ("^all advertising materials mentioning features or use of this software must display the following "
     "acknowledge?ment this product includes software developed by .+$", normal(SENTENCES["bsd-advertising"][0])),
    ("^(?:.+ is free software )?you can redistribute it and or modify it under the terms of the gnu "
     "(lesser |library |affero |)general public license as published by the free software foundation "
     "(?:either )?version (2 1|2|3) of the license( or at your option any later version|)$",
     GNU_NOTICE.format("$1", "$2", "$3")),
    ("^this program and the accompanying materials are made available under the terms of the eclipse public license "
     "(?:v|version |)([12]) 0(?: .+|)$", "licensed under the eclipse public license $1 0"),
]

#: Rules in order: licence and the identifiers that must follow each other.
RULES = [
    ("JSON", ["mit-grant", "mit-condition", "json-good"]),
    ("MIT", ["mit-grant", "mit-condition"]),
    ("ISC", ["isc-grant"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("Apache-2.0", ["apache-notice", "apache-use"]),
    ("Zlib", ["zlib-grant"]),
    ("BSL-1.0", ["bsl-grant"]),
    ("GPL-3.0-or-later", ["gnu-gpl-3-or-later", "gpl-hope"]),
    *((f"{kind.upper()}-{spdx}{end}", rule) for kind, (version, spdx), end in product(
        sorted(set(GNU.values())), GNU_VERSIONS.items(), GNU_ENDS) for rule in (
            [f"gnu-{kind}-{version}{end}"], [f"gnu-{kind}-terms", f"gnu-{version}{end}"])),
    *((name, [f"spdx-{name.lower()}"]) for name in SPDX),
    *((f"CC-{kind}-{version}", [f"cc-{kind.lower()}-{version}"]) for kind, version in product(CC_KINDS, CC_VERSIONS)),
    ("CC0-1.0", ["cc0-notice"]),
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-basis"]),
    ("AGPL-3.0", ["agpl-notice"]),
    ("LGPL-3.0", ["lgpl-notice"]),
    ("GPL-3.0", ["gpl-3-notice"]),
    ("GPL-2.0", ["gpl-2-notice"]),
    ("MPL-2.0", ["mpl-notice"]),
    ("EPL-2.0", ["epl-2-notice"]),
    ("EPL-1.0", ["epl-1-notice"]),
    ("BSL-1.0", ["bsl-notice"]),
    ("Zlib", ["zlib-notice"]),
    ("Artistic-2.0", ["artistic-notice"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-title", "as-is"]),
    ("ISC", ["isc-title", "as-is"]),
    ("MIT", ["mit-title"]),
    ("Artistic-2.0", ["artistic-title"]),
    ("BSD-3-Clause", ["bsd-3-notice"]),
    ("BSD-2-Clause", ["bsd-2-notice"]),
    ("Unlicense", ["unlicense-title"]),
    ("public-domain", ["public-domain"]),
    ("all-rights-reserved", ["reserved"]),
]
STRICT = {"BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause"}
#: Every known sentence holds one of these, so texts without any are not cut.
TRIGGERS = ["licen", "permi", "reserved", "warrant", "redistribut", "copyright", "domain", "released", "advertising", "not evil"]
#: An unknown sentence is a condition if it holds the first and one of the others.
CONDITION = ["this software", " may ", " must "]
UNKNOWN = "!"

#: Blank lines and numbered or dashed items begin a sentence; other line ends and comment marks do not.
BREAK = r"[ \t\r]*\n([ \t\r]*\n[ \t\r\n]*|[ \t]*([0-9]+[.)]|-+)[ \t]+)"
WRAP = r"\n[ \t]*[*#/]*[ \t]*"
END = r"[.!?;]+([ \t\r\n]|$)"


def known_sentences() -> dict[str, str]:
    """Identifier by normal sentence."""
    known = {normal(s): name for name, some in SENTENCES.items() for s in some}
    for kind, version in product(CC_KINDS, CC_VERSIONS):
        for phrase in CC_PHRASES:
            known[normal(phrase.format(f"{kind} {version}"))] = f"cc-{kind.lower()}-{version}"
    for (word, kind), version, (end, words) in product(GNU.items(), GNU_VERSIONS, GNU_ENDS.items()):
        known[normal(GNU_NOTICE.format(word, version, words))] = f"gnu-{kind}-{version}{end}"
        known[normal(f"{'either ' * bool(words)}version {version} of the License{words}")] = f"gnu-{version}{end}"
    known |= {normal(p.format("0 1.0").replace("CC ", "CC")): "cc0-notice" for p in CC_PHRASES}
    return known | {normal(f"SPDX-License-Identifier: {name}"): f"spdx-{name.lower()}" for name in SPDX}


def rule_pattern(names: list[str], strict: bool) -> str:
    """A pattern for sequences written ``,a,b,c,``; the two sequences of a text are parted by a bar."""
    others = f"[^|{UNKNOWN}]*" if strict else "[^|]*"
    return f",({others},)?".join(re.escape(n) for n in names).join((",", "," + f"{others}([|]|$)" * strict))


def formed(pattern: str, form: str) -> Callable[[Column], Column]:
    return lambda s: F.regexp_replace(s, pattern, form)


def sequences(text: Column) -> Column:
    """Both sequences of a text, written ``,a,b,|,a,b,``."""
    known = known_sentences()
    look = F.create_map(*(F.lit(x) for pair in sorted(known.items()) for x in pair))

    def found(parts: Column) -> Column:
        bare = F.transform(parts, lambda s: F.replace(
            F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")), F.lit("licence"), F.lit("license")))
        for pattern, form in GAPS:
            bare = F.transform(bare, formed(pattern, form))
        subject, *verbs = CONDITION
        named = F.transform(bare, lambda s: F.coalesce(F.try_element_at(look, s), F.when(
            F.contains(s, F.lit(subject)) & reduce(Column.__or__, (F.contains(s, F.lit(v)) for v in verbs)), UNKNOWN)))
        joined = F.array_join(F.filter(named, lambda n: n.isNotNull()), ",")
        return F.when(joined.rlike("[a-z]"), F.concat(F.lit(","), joined, F.lit(","))).otherwise(F.lit(""))

    small = F.regexp_replace(F.lower(text), VERSION, "$1v$2")
    flowing = F.regexp_replace(F.regexp_replace(small, BREAK, ". "), WRAP, " ")
    lines = F.regexp_replace(small, r"[\r\n]+", ". ")
    both = F.concat(found(F.split(flowing, END)), F.lit("|"), found(F.split(lines, END)))
    holds = F.lit(False)
    for trigger in TRIGGERS:
        holds = holds | F.contains(small, F.lit(trigger))
    return F.when(F.coalesce(holds, F.lit(False)), both).otherwise(F.lit("|"))


def licensed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``license`` (null: none), ``license_sentences`` (both sequences) and ``n_license_sentences``."""
    found = docs.withColumn("license_sentences", sequences(F.col(text)))
    names = F.lit(None).cast("string")
    for name, rule in reversed(RULES):
        names = F.when(F.col("license_sentences").rlike(rule_pattern(rule, name in STRICT)), F.lit(name)).otherwise(names)
    lines = F.split(F.col("license_sentences"), r"\|")
    counts = F.greatest(*(F.size(F.filter(F.split(F.get(lines, F.lit(i)), ","), lambda n: ~n.isin("", UNKNOWN))) for i in (0, 1)))
    return found.withColumn("license", F.when(F.col("license_sentences") != "|", names)).withColumn(
        "n_license_sentences", counts.cast("long"))


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle(table: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """The same in SQL."""
    known = sorted(known_sentences().items())
    look = f"map([{', '.join(_quoted(s) for s, _ in known)}], [{', '.join(_quoted(n) for _, n in known)}])"
    holds = " OR ".join(f"contains(small, {_quoted(t)})" for t in TRIGGERS)
    names = " ".join(f"WHEN regexp_matches(seq, {_quoted(rule_pattern(rule, name in STRICT))}) THEN {_quoted(name)}" for name, rule in RULES)

    def found(parts):
        bare = "replace(trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')), 'licence', 'license')"
        for pattern, form in GAPS:
            bare = f"regexp_replace({bare}, {_quoted(pattern)}, {_quoted(form.replace('$', chr(92)))})"
        return (f"list_filter(list_transform(list_transform(string_split_regex({parts}, {_quoted(END)}), lambda s: {bare}), "
                f"lambda s: coalesce(look[s], CASE WHEN {condition} THEN {_quoted(UNKNOWN)} END)), lambda n: n IS NOT NULL)")

    subject, *verbs = CONDITION
    condition = f"contains(s, {_quoted(subject)}) AND ({' OR '.join(f'contains(s, {_quoted(v)})' for v in verbs)})"
    counted = f"greatest(len(list_filter(a, lambda n: n <> {_quoted(UNKNOWN)})), len(list_filter(b, lambda n: n <> {_quoted(UNKNOWN)})))"

    def listed(ids):
        joined = f"array_to_string({ids}, ',')"
        return f"CASE WHEN regexp_matches({joined}, '[a-z]') THEN ',' || {joined} || ',' ELSE '' END"

    flowing = f"regexp_replace(regexp_replace(small, {_quoted(BREAK)}, '. ', 'g'), {_quoted(WRAP)}, ' ', 'g')"
    lines = "regexp_replace(small, '[\\r\\n]+', '. ', 'g')"
    return f"""WITH known AS (SELECT {look} AS look),
cut AS (SELECT {key}, CASE WHEN {holds} THEN {found(flowing)} ELSE [] END AS a,
        CASE WHEN {holds} THEN {found(lines)} ELSE [] END AS b
        FROM (SELECT {key}, regexp_replace(lower(coalesce({text}, '')), {_quoted(VERSION)}, '\\1v\\2', 'g') AS small FROM {table}), known),
marked AS (SELECT {key}, {counted} AS n_license_sentences, {listed('a')} || '|' || {listed('b')} AS seq FROM cut)
SELECT {key}, CASE {names} END AS license, seq AS license_sentences,
       CAST(n_license_sentences AS BIGINT) AS n_license_sentences FROM marked"""
