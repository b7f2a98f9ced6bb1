import textwrap

import duckdb

from pyspark.sql import functions as F

from factweave.llm import hosts, licences
from factweave.llm.common import pick

MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and so on.\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, express or implied."


def test_licences_equal_sql_and_hold_the_rules(spark, tmp_path):
    texts = [None, "", "no hint", "All rights reserved.", "Licensed under the Apache License, Version 2.0. Released under the MIT License.", f"Head\n{MIT}\ntail", "This work is licensed under the GNU General Public License, version 3.\nAll rights reserved.",
             "Licensed under CC BY-NC 4.0.", "licensed under  CC BY 4.0!! x", "You may not use this file except in compliance with the License.", "SPDX-License-Identifier: MIT", "word " * 20000 + "\nReleased under the MIT License.", "Released under the MIT License. " * 3]
    rows = [(i, t, "c", "c") for i, t in enumerate(texts)] + [(None, "All rights reserved.", "c", "c"), (3, "All rights reserved.", "c", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, Text string")
    got = licences.scan(docs)
    found = {r["doc_id"]: (r["licences"], r["n_unmatched"]) for r in got.collect()}
    assert found[0] == found[1] == found[2] == ("", 0)
    assert found[4] == ("Apache-2.0,MIT", 0) and found[5] == ("MIT", 0) and found[6] == ("GPL-3.0,All-Rights-Reserved", 0)
    assert found[7] == ("CC-BY-NC", 0) and found[8] == ("CC-BY", 0) and found[9] == ("", 1) and found[11] == found[12] == ("MIT", 0)
    pick(docs, doc_id="doc_id", text="text").coalesce(1).write.parquet(str(tmp_path / "d"))
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    want = duckdb.sql(licences.oracle_sql()).fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert licences.scan(docs.where("doc_id < 0")).count() == 0


APACHE = """Copyright 2020 Some Body

Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
MIT_WHOLE = """Copyright (c) 2019 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD = """Copyright (c) 2001, Some Body. All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{0}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES."""
ENDORSE = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""
#: Written by hand: licence texts, and what is to be found in them.
KNOWN = {
    APACHE: "Apache-2.0", MIT_WHOLE: "MIT", BSD.format(""): "BSD-2-Clause,All-Rights-Reserved", BSD.format(ENDORSE): "BSD-3-Clause,All-Rights-Reserved", GPL: "GPL-3.0", GPL.replace("version 3", "version 2"): "GPL-2.0",
    GPL.replace("General", "Lesser General"): "LGPL", GPL.replace("General", "Affero General"): "AGPL-3.0", ISC: "ISC", ZLIB: "Zlib", MPL: "MPL-2.0", UNLICENSE: "Unlicense",
}
LINES = {
    "SPDX-License-Identifier: MIT": "MIT", "# SPDX-License-Identifier: Apache-2.0 OR MIT\nimport os": "Apache-2.0,MIT", "// SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0", "released under CC0 1.0": "CC0", "Released under CC0 1.0.": "CC0",
    "(c) 2020 Foo Bar": "", "Copyright © 2020 Foo\nAll rights reserved": "All-Rights-Reserved", "no end mark before it\nAll rights reserved.\nnext line": "All-Rights-Reserved", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "text at https://creativecommons.org/licenses/by-nc/4.0/ here": "CC-BY-NC", "licensed under GPL v3": "GPL-3.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "CC-BY-SA", "licensed under the\nMIT license": "MIT",
    "He asked for permission, and the notice said that redistribution of wealth is a licence to print money.": "", "The general public is free to copy the public domain of thought": "", "the mit was licensed": "",
}


def test_whole_licences_however_they_are_wrapped(spark, tmp_path):
    marks = {"": "", "# ": "#", "// ": "//", " * ": " *"}
    rows, want = [], []
    for text, licence in KNOWN.items():
        for width in (60, 80, 10_000):
            for mark, blank in marks.items():
                lines = [mark + line if line else blank for part in text.split("\n") for line in (textwrap.wrap(part, width) or [""])]
                rows.append("some code\n\n" + "\n".join(lines) + "\n\nmore code")
                want.append(licence)
    rows += LINES
    want += LINES.values()
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: r["licences"] for r in licences.scan(docs).collect()}
    assert [(rows[i][:90], got[i]) for i in got if got[i] != want[i]] == []
    docs.coalesce(1).write.parquet(str(tmp_path / "d"))
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    assert sorted(map(tuple, licences.scan(docs).collect())) == sorted(duckdb.sql(licences.oracle_sql()).fetchall())


def test_every_pattern_holds_its_word():
    for name, word, pattern in licences.SENTENCES:
        assert word in pattern.replace("[.]", ".").replace("[ -]", " ").replace("acknowledge?ment", "acknowledgment").replace("licen[sc]e", "license") or word == "commons", name


def test_reputation_of_hosts_that_differ(spark, tmp_path):
    """Hosts of one domain that are bad beyond chance are blocked, small ones by their domain; and the SQL agrees."""
    rows, labels, n = [], [], 0
    for host, pages_, bad in [("a.spam.com", 200, 150), ("b.spam.com", 3, 3), ("c.spam.com", 1, 0), ("x.good.org", 300, 30), ("y.good.org", 250, 20), ("new.spam.com", 0, 0), ("u.blogspot.com", 80, 60), ("v.blogspot.com", 80, 4), ("w.co.uk", 40, 2)]:
        for i in range(max(1, pages_)):
            rows.append((n, f"https://{host}/en/{n}"))
            if pages_:
                labels.append((n, 0 if i < bad else 1, 0))
            n += 1
    rows += [(n, "x" * 100_000), (n + 1, "https://" + "h." * 20_000 + "good.org/" + "p" * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    judged = hosts.judge_urls(pages, hosts.label_outcomes(pages, known)).collect()
    blocked = {r["host"] for r in judged if r["verdict"] == "block" and r["rule"] is None}
    assert {"a.spam.com", "b.spam.com", "u.blogspot.com"} <= blocked and not {"x.good.org", "y.good.org", "v.blogspot.com", "w.co.uk"} & blocked
    domain, suffix = hosts.domain_and_suffix(F.col("h"))
    split = spark.createDataFrame([("a.b.co.uk",), ("u.blogspot.com",), ("x.y.example.com",), ("localhost",), ("",)], "h string").select(domain, suffix).collect()
    assert [tuple(r) for r in split] == [("b.co.uk", "co.uk"), ("u.blogspot.com", "blogspot.com"), ("example.com", "com"), ("localhost", "localhost"), ("", "")]
    pages.coalesce(1).write.parquet(str(tmp_path / "p"))
    known.coalesce(1).write.parquet(str(tmp_path / "l"))
    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{tmp_path}/p/*.parquet'; CREATE OR REPLACE VIEW labels AS SELECT * FROM '{tmp_path}/l/*.parquet'")
    key = lambda r: (r[0], r[1], r[2], r[3] or "", r[4], r[5])
    assert sorted(map(key, plain_rows(judged))) == sorted(map(key, duckdb.sql(hosts.oracle_sql()).fetchall()))


def plain_rows(rows):
    return [(*tuple(r)[:5], round(r["bad_rate_bound"], 6)) for r in rows]


def test_rules_and_reputation(spark):
    urls = ["http://A.Example.NET/en/1", "https://example.com/de/x?y", "http://x.example.com/fr/", "http://a.org/fr/1", "http://net/", "http://net", "http://notnet/x", None, "no scheme", "x://", "http://h.example.org/#a/b", "http://b.co.uk/p://q"]
    rows = [(i, u, "c", "c") for i, u in enumerate(urls)] + [(None, "http://spam.example.com/a", "c", "c"), (0, urls[0], "c", "c")]
    rows += [(100 + i, f"http://{'spam' if i % 2 else 'good'}.example.com/en/{i}", "c", "c") for i in range(80)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, Host string")
    labels = spark.createDataFrame([(i, 0 if i % 2 else 1, None) for i in range(80)] + [(None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: r for r in hosts.judge_urls(pages, hosts.label_outcomes(pages, labels)).collect()}
    want = {0: ("a.example.net", "/en/1", "example.net/en/", "allow"), 1: ("example.com", "/de/x", "example.com/de/", "block"), 3: ("a.org", "/fr/1", "org/fr/", "allow"), 4: ("net", "/", "net/", "block"), 11: ("b.co.uk", "/p://q", None, "allow")}
    for k, v in want.items():
        assert (got[k]["host"], got[k]["path"], got[k]["rule"], got[k]["verdict"]) == v
    assert got[5]["path"] == "" and got[5]["rule"] is None and got[6]["rule"] is None and got[10]["path"] == "/"
    assert all((got[k]["host"], got[k]["path"]) == ("", "") for k in (7, 8, 9))
    assert got[None]["verdict"] == got[101]["verdict"] == "block" and got[100]["verdict"] == "allow"
    assert hosts.judge_urls(pages.where("page_id < -1"), hosts.label_outcomes(pages, labels)).count() == 0
    nothing = hosts.judge_urls(pages, hosts.label_outcomes(pages, labels.where("quality > 7")))
    assert nothing.count() == len(rows) and nothing.where("verdict = 'block' and rule is null").count() == 0
