"""Licence sentences and rules on texts written by hand."""

import pytest
from pyspark.sql import functions as F

from grist.llm import licenses as L

MIT = """/*
 * Copyright (c) 2020 Some Body
 *
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 * to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
 * copies of the Software, and to permit persons to whom the Software is
 * furnished to do so, subject to the following conditions:
 *
 * The above copyright notice and this permission notice shall be included in
 * all copies or substantial portions of the Software.
 */"""
GPL = """This program is free software; you can redistribute it and/or modify it under
the terms of the GNU General Public License as published by the Free Software
Foundation; either version 2 of the License, or (at your option) any later version."""

CASES = [
    (1, None, [], []), (2, "", [], []), (3, "no such words here.", [], []),
    (4, "a b c\nLicensed under CC BY-NC 4.0.\nmore", ["CCBYNCRef"], ["CC-BY-NC-4.0"]),
    (5, "x. This work is licensed under the GNU General Public License, version 3. y", ["GPL3Ref"], ["GPL-3.0"]),
    (6, MIT, ["Copyright", "MITGrant", "MITNotice"], ["MIT"]), (7, GPL, ["GPLRedist2"], ["GPL-2.0-or-later"]),
    (8, "Released under the MIT License.\nReleased under the MIT License.\nLicensed under the Apache License, Version 2.0.", ["MITRef", "MITRef", "ApacheRef"], ["Apache-2.0", "MIT"]),
    (9, "My licence to kill, by permission.", [], []), (9, "RELEASED UNDER THE MIT LICENSE!", ["MITRef"], ["MIT"]),
    (10, "All rights reserved.", ["AllRights"], []),
]


def test_cases(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t, _, _ in CASES], "doc_id long, text string, licences string")
    got = [(r.sentences, r.licences) for r in L.recognise(docs).collect()]
    assert got == [(s, x) for _, _, s, x in CASES]
    assert L.recognise(docs.limit(0)).count() == 0


def test_special_rules_come_before_general_ones(spark):
    bsd = ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
           "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
           "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
           "and/or other materials provided with the distribution.",
           "Neither the name of The Group nor the names of its contributors may be used to endorse or promote products derived from this software without "
           "specific prior written permission."]
    docs = spark.createDataFrame([(1, "\n".join(bsd)), (2, "\n".join(bsd[:3])), (3, bsd[1])], "doc_id long, text string")
    got = [(r.licences, r.unmatched) for r in L.recognise(docs).orderBy("doc_id").collect()]
    assert got == [(["BSD-3-Clause"], []), (["BSD-2-Clause"], []), ([], ["BSDSource"])]


def test_every_known_sentence_has_a_trigger():
    import re

    for own in L.SENTENCES.values():
        for s in own:
            assert re.search(L.trigger_pattern(), s), s


def test_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = L.recognise(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_every_planted_line_is_found(spark, sf):
    from grist.llm.registry import QUERIES

    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT"}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = {r.doc_id: r.licences for r in QUERIES["op5_license_scan"](spark, sf).filter(F.col("licences") != "").collect()}
    expected = {i: {x for s, x in lines.items() if s in t} for i, t in texts.items()}
    assert {i: set(x.split(",")) for i, x in found.items()} == {i: x for i, x in expected.items() if x} and found


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
AS_IS = """

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
MIT_FULL = "MIT License\n\n" + MIT.replace("/*\n", "").replace(" */", "").replace(" * ", "").replace(" *", "").strip() + AS_IS
ISC = """Copyright (c) 2020, Some Body

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""
BSD = """Copyright (c) 2020, Some Body
All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
NOTICES = [(APACHE, "Apache-2.0"), (APACHE.replace("http:", "https:"), "Apache-2.0"), (MIT_FULL, "MIT"),
           (GPL, "GPL-2.0-or-later"), (GPL.replace("version 2", "version 3"), "GPL-3.0-or-later"), (MPL, "MPL-2.0")]


def test_full_notices_wrapped_reflowed_and_on_one_line(spark):
    import textwrap

    forms = []
    for notice, licence in NOTICES:
        paragraphs = [" ".join(p.split()) for p in notice.split("\n\n")]
        for width in (30, 47, 60, 72, 79, 100, 10_000):
            wrapped = "\n\n".join(textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False) for p in paragraphs)
            forms += [(wrapped, licence), ("".join(f"# {line}\n" for line in wrapped.split("\n")), licence)]
            forms.append((textwrap.fill(" ".join(paragraphs), width, break_long_words=False, break_on_hyphens=False), licence))
        forms += [(notice, licence), (f"Some words.\n\n{notice}\n\nOther words.", licence), (" ".join(notice.split()), licence)]
    # wrapped to a narrow width, a line of these may begin with 'copyright': README names it as open
    forms += [(form, licence) for notice, licence in ((ISC, "ISC"), (BSD, "BSD-2-Clause")) for form in (notice, " ".join(notice.split()))]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(forms)], "doc_id long, text string")
    got = {r.doc_id: r.licences for r in L.recognise(docs).collect()}
    assert [(forms[i][0], x) for i, x in sorted(got.items()) if x != [forms[i][1]]] == []
