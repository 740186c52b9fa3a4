import re

import duckdb
import pytest

from tabprep.llm import license_scan as L
from tabprep.llm import queries

from .conftest import EDGE

MIT = """Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission."""

CASES = [
    (MIT, "MIT"),
    (BSD, "BSD-2-Clause"),
    (BSD + "3. " + NAMES, "BSD-3-Clause"),
    ("Words first.\nReleased under the MIT License.\nMore words", "MIT"),
    ("no stop at the end\nLicensed under CC BY-NC 4.0.\nnext", "CC-BY-NC-4.0"),
    ("// SPDX-License-Identifier: Apache-2.0\ncode", "Apache-2.0"),
    ("This license is my own. All rights reserved. Licensed under the Apache License, Version 2.0.", "Apache-2.0,all-rights-reserved"),
    ("We talk of a license and of permission only.", ""),
    ("The MIT grants permission", ""),
]


#: The standard notice of every licence in RULES, as its steward gives it.
NOTICES = {
    "Apache-2.0": """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.""",
    "GPL-3.0-or-later": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.""",
    "GPL-2.0-or-later": """    This program is free software; you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation; either version 2 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.""",
    "MIT": MIT,
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "BSD-3-Clause": BSD + "3. " + NAMES,
    "BSD-2-Clause": BSD,
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "GPL-3.0-only": "This work is licensed under the GNU General Public License version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "all-rights-reserved": "All rights reserved.",
}


def test_standard_notice_of_every_licence(frame):
    assert set(NOTICES) == {name for name, _ in L.RULES}
    rows = [(i, before + text + after) for i, text in enumerate(NOTICES.values()) for before, after in (("", ""), ("Some words.\n\n", "\n\nMore of them."))]
    found = [(r.doc_id, r.licenses) for r in L.scanned(frame(rows).withColumnRenamed("lang", "licenses")).collect()]
    assert sorted(found) == sorted((i, [name]) for i, name in enumerate(NOTICES) for _ in range(2))


def test_another_version_is_another_licence(frame):
    rows = [(1, NOTICES["MPL-2.0"].replace("2.0", "3.0")), (2, NOTICES["GPL-2.0-or-later"].replace("version 2", "version 1"))]
    assert [r.licenses for r in L.scanned(frame(rows).withColumnRenamed("lang", "licenses")).collect()] == [[], []]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_cases(frame, case):
    text, licenses = CASES[case]
    row = L.scanned(frame([(1, text)]).withColumnRenamed("lang", "licenses")).first()
    assert ",".join(row.licenses) == licenses


def test_every_known_sentence_has_a_trigger_and_its_normal_form():
    for s in L.SENTENCES.values():
        assert re.search(L.TRIGGER, s) and re.fullmatch("[a-z0-9]+( [a-z0-9]+)*", s)
    assert len(set(L.SENTENCES.values())) == len(L.SENTENCES)
    assert {x.strip("()") for _, r in L.RULES for x in r.split()} == set(L.SENTENCES)


@pytest.mark.parametrize("gap", [" ", "  ", "\t", "\n", "\n   ", "-", "\n * ", "\u00a0"])
def test_words_parted_in_any_way_as_in_the_sql(frame, tmp_path, gap):
    notices = ["(c) 2020 Acme. All rights reserved.", "Version 2 0.", "It is mine. 2 0. Yours.", "This program is free software; nothing more.", *NOTICES.values()]
    rows = [(i, text.replace(" ", gap)) for i, text in enumerate(notices)] + [(100 + i, re.sub(r"(?i)\b(rights|free|2) ", lambda m: m[1] + gap, text)) for i, text in enumerate(notices)]
    path = str(tmp_path / "documents.parquet")
    frame(rows).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    expected = con.execute(queries.ORACLES["op9_license_scans"]).fetchall()
    out = queries.op9_license_scans(frame(rows).sparkSession, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.n_sentences, r.sentence_ids, r.licenses) for r in out) == sorted(expected)
    assert {r.doc_id: r.licenses for r in out}[100] == "all-rights-reserved"


def test_edge_rows(frame):
    assert [r.licenses for r in L.scanned(frame(EDGE)).collect()] == [[]] * len(EDGE)
    assert L.scanned(frame([])).collect() == []
