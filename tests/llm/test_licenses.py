"""Licences of unabridged notices, wrapped and marked as comments."""

import textwrap

import pytest

from brisa.llm import licenses

MIT = """Copyright (c) 2020 A. Person

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
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

GPL = """{name} is free software{mark} you can redistribute it and/or modify
it under the terms of the GNU {kind}General Public License as published by
the Free Software Foundation{joint} either version {version} of the License, or
(at your option) any later version.

{name} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""

BSD = """Copyright (c) 2011, Some Group
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{names}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT OWNER OR CONTRIBUTORS BE LIABLE."""

NAMES = """3. Neither the name of {} nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
"""

MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""

NOTICES = {
    "MIT": [MIT, "SPDX-License-Identifier: MIT", "License: MIT"],
    "Apache-2.0": [APACHE, APACHE.replace("at\n\n    http:", "at https:"), "SPDX-License-Identifier: Apache-2.0"],
    "GPL-3.0-or-later": [
        GPL.format(name="This program", mark=":", kind="", joint=",", version=3),
        GPL.format(name="GNU Some Tool", mark=":", kind="", joint=",", version=3), "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "GPL-2.0-or-later": [
        GPL.format(name="This program", mark=";", kind="", joint=";", version=2), "SPDX-License-Identifier: GPL-2.0+",
    ],
    "LGPL-3.0-or-later": [GPL.format(name="This library", mark=":", kind="Lesser ", joint=",", version=3)],
    "LGPL-2.1-or-later": [GPL.format(name="This library", mark=";", kind="Lesser ", joint=";", version="2.1")],
    "AGPL-3.0-or-later": [GPL.format(name="This program", mark=":", kind="Affero ", joint=",", version=3)],
    "BSD-2-Clause": [BSD.format(names="")],
    "BSD-3-Clause": [BSD.format(names=NAMES.format(who)) for who in ("the copyright holder", "the University of Somewhere Else")],
    "MPL-2.0": [MPL],
    "Proprietary": ["Copyright 2020 Some Company. All rights\nreserved."],
}

MARKS = {"plain": ("", ""), "hash": ("# ", ""), "star": (" * ", ""), "rem": ("REM ", ""), "dnl": ("dnl ", ""), "cr": ("", "\r"), "slash": ("//! ", "")}


def marked(text, before, after):
    return "\n".join(f"{before}{line}{after}" if line else before.rstrip() + after for line in text.split("\n"))


@pytest.mark.parametrize("style", MARKS)
def test_whole_notices(make, style):
    cases = [(licence, f"#!/bin/x\nimport os\n{marked(t, *MARKS[style])}\n\ndef f():\n    pass") for licence, texts in NOTICES.items() for t in texts]
    got = {r.doc_id: r for r in licenses.scan(make([(i, t, "en", "a") for i, (_, t) in enumerate(cases)])).collect()}
    found = [(licence, got[i].licenses, got[i].unmatched) for i, (licence, _) in enumerate(cases)]
    assert found == [(licence, licence, "") for licence, _ in cases]


def test_every_rule_on_its_wrapped_sentences(make):
    known = licenses.known_by_name()
    rules = [*licenses.NOTICE_RULES, *licenses.RULES]
    rows, wanted = [], []
    for licence, run in rules:
        for k in range(max(len(known[name]) for name in run)):
            texts = [known[name][min(k, len(known[name]) - 1)].replace("*", "some longer name") for name in run]
            rows.append((len(rows), "\n".join(textwrap.fill(t + ".", 30, initial_indent="// ", subsequent_indent="// ") for t in texts), "en", "a"))
            wanted.append((licence, run))
    got = {r.doc_id: r for r in licenses.scan(make(rows)).collect()}
    wrong = [(w, got[i].sentences, got[i].licenses) for i, w in enumerate(wanted) if got[i].licenses != w[0]]
    assert wrong == []


def test_no_sentence_goes_over_a_stop_or_a_blank_line(make):
    rows = [
        (1, "Licensed under\n\nthe MIT License.", "en", "a"), (2, "Licensed under. The MIT License.", "en", "a"),
        (3, "never licensed under the MIT License.", "en", "a"), (4, "licensed under the MIT License of old", "en", "a"),
        (5, "| ~\x01\x02 |\nReleased under the MIT License|\n~", "en", "a"), (6, "software" + "." * 200_000 + ":" * 200_000 + "\n" * 200_000, "en", "a"),
        (8, "License: MIT\n" + GPL.format(name="Foo", mark=":", kind="", joint=",", version=3), "en", "a"),
        (7, "software " + "a" * 300_000 + " is free software" + " \n" * 100_000 + "." , "en", "a"),
    ]
    got = {r.doc_id: r for r in licenses.scan(make(rows)).collect()}
    assert [got[i].licenses for i in range(1, 9)] == ["", "", "", "", "MIT", "", "", "MIT,GPL-3.0-or-later"]
