import textwrap

import duckdb

from .conftest import ODD, SF

from strata.llm import licenses

MIT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""
BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
]
CASES = {
    "mit": (MIT, "MIT", ""),
    "bsd3": ("\n".join(BSD), "BSD-3-Clause", ""),
    "bsd2": ("\n".join(BSD[:3]), "BSD-2-Clause", ""),
    "out of order": ("\n".join(BSD[:3][::-1]), "", "BsdBinary,BsdSource,BsdGrant"),
    "grant": ("Some prose.\nThis work is licensed under the GNU General Public License, version 3.", "GPL-3.0-only", ""),
    "two": ("Released under the MIT License. Licensed under CC BY-NC 4.0!\nA. All rights reserved.", "All-rights-reserved,CC-BY-NC-4.0,MIT", ""),
    "apache": ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.", "Apache-2.0", ""),
    "unknown name": ("Licensed under the Moon License.", "", ""),
    "part of a sentence": ("They said it is not licensed under the MIT License.", "", ""),
    "empty": ("", "", ""),
    "null": (None, "", ""),
    "tags in text": ("<MitGrant> {MIT}", "", ""),
}


def test_rules_on_licence_texts(spark):
    df = spark.createDataFrame([(k, v[0], 1, 2) for k, v in CASES.items()], "doc_id string, text string, ids int, found int")
    got = {r.doc_id: (r.licenses, r.unmatched) for r in licenses.recognise(df).collect()}
    assert got == {k: v[1:] for k, v in CASES.items()}


def compare(spark, con):
    return sorted(con.execute(licenses.oracle()).fetchall(), key=str)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    for sf in (SF, SF.replace("0.001", "0.01")):
        con.execute(f"create or replace view documents as select * from '{sf}/documents.parquet'")
        assert sorted(map(tuple, licenses.op2_licenses(spark, sf).collect()), key=str) == compare(spark, con)


def test_odd_rows(spark, odd, none):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [r[:2] for r in ODD])
    assert sorted(map(tuple, licenses.recognise(odd).collect()), key=str) == compare(spark, con)
    assert licenses.recognise(none).count() == 0


#: As the notices are shipped, with their line breaks.
NOTICES = {
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law""",
}
NOTICES["GPL-2.0-or-later"] = NOTICES["GPL-3.0-or-later"].replace("software: you", "software; you").replace("version 3", "version 2")


def wrapped(sentences, width):
    return "\n".join(textwrap.fill(s, width, break_on_hyphens=False) for s in sentences)


def test_notices_as_shipped(spark):
    texts = {(k, mark): "Copyright 2020 A\n" + "\n".join(mark + line for line in t.splitlines()) for k, t in NOTICES.items() for mark in ("", "# ", " * ", "// ")}
    texts["MIT", ""] = wrapped(MIT.split("\n"), 78)
    texts["BSD-3-Clause", ""] = wrapped([BSD[0], *[f"{i}. {s}" for i, s in enumerate(BSD[1:], 1)]], 78)
    df = spark.createDataFrame([(k, mark, t) for (k, mark), t in texts.items()], "k string, doc_id string, text string")
    for k in {k for k, _ in texts}:
        for r in licenses.recognise(df.filter(df.k == k)).collect():
            assert (k, r.licenses, r.unmatched) == (k, k, "")


def test_every_sentence_and_rule_wrapped(spark):
    said = {i: s for s, i in licenses.SENTENCES.items()} | {f"Grant:{i}": f"Licensed under the {s}" for s, i in licenses.NAMES.items()}
    rows = [(i, wrapped([s.upper() + "."], 40)) for i, s in said.items()]
    rows += [(str(n), wrapped([said[i] + "." for i in ids], 40)) for n, (_, ids) in enumerate(licenses.RULES)]
    got = {r.doc_id: r for r in licenses.recognise(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert [i for i in said if got[i].n_sentences != 1] == []
    assert [got[str(n)].licenses for n in range(len(licenses.RULES))] == [spdx for spdx, _ in licenses.RULES]


FULL = {
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.""",
    "EPL-2.0": """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "Apache-2.0": NOTICES["Apache-2.0"] + """ or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "Zlib": """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:""",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.",
}
FULL["LGPL-3.0-or-later"] = FULL["LGPL-2.1-or-later"].replace("version 2.1", "version 3")
FULL["AGPL-3.0-or-later"] = NOTICES["GPL-3.0-or-later"].replace("GNU General", "GNU Affero General")


def test_operator_and_sql_agree_on_notices(spark):
    """Wrapped at any width, commented, one word to a line, cut short, between other text."""
    texts = [(k, t) for notices in (NOTICES, FULL) for k, t in notices.items()] + [("MIT", MIT), ("BSD-3-Clause", "\n".join(BSD))]
    rows, want = [], []
    for k, t in texts:
        for form in (
            t,
            *("\n".join(mark + line for line in t.splitlines()) for mark in ("# ", " * ", "// ")),
            "\n".join(t.split()),
            *("\n".join(wrapped([part], w) for part in t.split("\n\n")) for w in (50, 78)),
            "Some prose, the\n" + t.upper() + "\nall rights reserved. The",
            t.replace(" ", " \t "),
            t[: len(t) // 2],
        ):
            rows.append((len(rows), form))
            want.append(k)
    rows += [(900 + i, text) for i, (text, *_) in enumerate(CASES.values())]
    rows += [(None, "the\nabove.\n\x01.a..b\x0b licensed under\x0bthe MIT license"), (950, "this\nthis work is\nlicensed\nunder the\nterms of the ISC license")]
    got = sorted(map(tuple, licenses.recognise(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    assert got == compare(spark, con)
    found = {r[0]: r[2:] for r in got}
    for i, k in enumerate(want):
        if i % 10 == 7:
            assert found[i] == (",".join(sorted([k, "All-rights-reserved"])), ""), (rows[i], found[i])
        elif i % 10 < 9:
            assert found[i] == (k, ""), (rows[i], found[i])
    assert found[950] == ("ISC", "")
