"""Cuts that a review found: each test fails on the code before its mending."""

import base64
import hashlib
import random
import time

from pyspark.sql import functions as F

from oxbow.llm import licenses, line_dedup, simhash, warc
from tests.llm.conftest import WORD, prose


def passages_brute(rows, window, words):
    """Text without the lines of runs of ``window`` lines or ``words`` words, or of
    whole shorter documents, that occur earlier."""
    docs = sorted(dict.fromkeys(rows), key=lambda r: (r[0] is None, r[0] or 0))
    lines = {d: [(i, x.strip()) for i, x in enumerate((d[1] or "").split("\n")) if x.strip()] for d in docs}
    seen, gone = set(), {d: set() for d in docs}
    for d in docs:
        own = lines[d]
        runs = [(own[s:s + n], "") for s in range(len(own)) for n in range(1, window + 1) if s + n <= len(own)
                and (n == window or sum(len(WORD.findall(x)) for _, x in own[s:s + n]) >= words)]
        for run, kind in [*runs, *([(own, "whole")] if 0 < len(own) < window else [])]:
            key = (kind, *[x for _, x in run])
            if key in seen:
                gone[d].update(i for i, _ in run)
            seen.add(key)
    return {d: "\n".join(x for i, x in enumerate((d[1] or "").split("\n")) if i not in gone[d]) for d in docs}


def test_repeats_of_few_lines_and_many_words(spark):
    rng = random.Random(7)
    shared = [prose(s, rng.choice((3, 20, 30, 49, 50, 70))) for s in range(15)]
    rows = [(i, "\n".join(rng.choice(["", "  "]) + rng.choice([*shared, prose(900 + i, 5)])
                          for _ in range(rng.randint(0, 7)))) for i in range(80)]
    rows += [(200, None), (201, prose(77, 90)), (202, prose(77, 90)), (203, "short"), (204, "short\n"), (205, "x\nshort\ny"),
             (None, "short"), (206, "a b\n\nc"), (207, "a b\nc")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = passages_brute(rows, 3, 50)
    got = line_dedup.dedup_lines(df, words=50).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(((d[0], want[d]) for d in rows), key=repr)
    left = {r.doc_id: r for r in got}
    assert left[202].text == left[204].text.strip() == left[207].text == "" and left[205].n_removed == 0


MIT = """MIT License

Copyright (c) 2020 A. Person

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
SOFTWARE.
"""
NAMES = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

"""
BSD3 = f"""BSD 3-Clause License

Copyright (c) 2020, A. Person
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

{NAMES}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
"""
GPL2 = GPL3.replace("software: you", "software; you").replace("Foundation, either version 3",
                                                              "Foundation; either version 2")


def test_wrapped_standard_licenses(spark):
    texts = {"MIT": MIT, "BSD-3-Clause": BSD3, "BSD-2-Clause": BSD3.replace(NAMES, ""), "GPL-3.0-or-later": GPL3,
             "GPL-2.0-or-later": GPL2}
    rows = [(mark + name, "\n".join(mark + x for x in text.split("\n")))
            for name, text in texts.items() for mark in ("", " * ", "# ", "// ")]
    rows += [(f"\r{name}", text.replace("\n", "\r\n")) for name, text in texts.items()]
    got = {r.doc_id: r.licenses for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {i: i.strip(" *#/\r") for i, _ in rows}
    parts = [(1, MIT.replace("without restriction", "with\n\nrestriction")), (2, "Released under\nthe MIT License"),
             (3, "not released under\nthe MIT License"), (4, "released under\n\nthe MIT License")]
    got = {r.doc_id: r.licenses for r in licenses.scan(spark.createDataFrame(parts, "doc_id long, text string")).collect()}
    assert got == {1: "", 2: "MIT", 3: "", 4: ""}


LATER = """{0} you can redistribute it and/or modify
it under the terms of the GNU {1} General Public License as published by
the Free Software Foundation{2} either version {3} of the License, or
(at your option) any later version.
"""
GRANT = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted{}.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE.
"""
FURTHER = {
    "LGPL-2.1-or-later": LATER.format("This library is free software;", "Lesser", ";", "2.1"),
    "LGPL-3.0-or-later": LATER.format("This program is free software:", "Lesser", ",", "3"),
    "AGPL-3.0-or-later": LATER.format("This program is free software:", "Affero", ",", "3"),
    "ISC": GRANT.format(""", provided that the above
copyright notice and this permission notice appear in all copies"""),
    "0BSD": GRANT.format(""),
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.
""",
    "Zlib": """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
""",
    "EPL-2.0": "Distributed under the Eclipse Public License 2.0.", "BSL-1.0": "x\nDistributed under the Boost Software License, Version 1.0.",
    "CC0-1.0": "This work is licensed under\nCC0 1.0!", "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0", "BSD-3-Clause": "Released under the BSD 3-Clause License",
}


def test_further_licenses(spark):
    rows = [(mark + name, "\n".join(mark + x for x in text.split("\n"))) for name, text in FURTHER.items() for mark in ("", " * ", "# ")]
    rows += [("cut", FURTHER["ISC"].replace("FITNESS.", "FITNESS AND MORE.")), ("order", FURTHER["Zlib"][::-1])]
    got = {r.doc_id: r.licenses for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {i: "" if i in ("cut", "order") else i.strip(" *#") for i, _ in rows}
    # Every rule can be met, and every sentence has words only and is in use.
    assert {i for _, rule in licenses.EVERY_RULE for i in rule} == set(licenses.KNOWN.values())
    assert all(k == " ".join("".join(c if c.isalnum() else " " for c in k.lower()).split()) for k in licenses.KNOWN)


def test_broken_html_in_linear_time(spark):
    """A megabyte of what is never closed; and what such a page gives."""
    n = 1 << 20
    rows = [(k, f"<p>start</p> {(unit * n)[:n]}") for k, unit in enumerate(
        ["<!-- x ", "<script> x ", "<style ", "<", "<p ", "</div ", "<title>", "<title ", "< a ", "<![CDATA[ ", "</script ", "&", "&#"])]
    rows += [(100, "a <!-- b > c"), (101, "a <script>var x = 1 < 2;</script> b <script> c > d"), (102, "a < b"), (103, "a < b > c"),
             (104, "x<style>p{}</style >y<STYLE>z"), (105, "1 <b>2</b> <i 3"), (106, "")]
    df = spark.createDataFrame(rows, "k int, html string").repartition(4).select(
        "k", warc.html_text(F.col("html")).alias("t"), warc.title(F.col("html")).alias("title"))
    began = time.time()
    got = {r.k: r for r in df.collect()}
    assert time.time() - began < 90
    assert [got[k].t for k in range(100, 107)] == ["a", "a b", "a < b", "a c", "xy", "1 2 <i 3", ""]
    assert got[0].t == got[1].t == "start" and got[6].title and all(got[k].t.startswith("start") for k in range(13))


def test_inline_tags_and_references(spark):
    inline = ("a abbr acronym b bdi bdo big button cite code data del dfn em font i img input ins kbd label map mark "
              "meter my-tag object output p-x picture progress q ruby s samp small span strong sub sup svg time tt u "
              "var wbr").split()
    block = ("address article aside blockquote body br dd details div dl dt fieldset figcaption figure footer form h1 "
             "h6 head header hr html li main nav ol option p pre section summary table tbody td th title tr ul").split()
    rows = [(t, f"on<{t} x='1'>e</{t.upper()}> word") for t in inline + block]
    rows += [("named", "&mdash;&eacute;&hellip;&Omega;&lt;p&gt;&nbsp;&apos;&copy;"),
             ("number", "&#8217;&#x27;&#X1F600;&#0233;&#150;&#0;&#xD800;&#99999999999999999999;&#160;.&#39;&#x110000;"),
             ("once", "&amp;lt; &amp;#38; &#38;amp; &unknown; & &; &#; &#x; &amp &eacute R&D; a&b"), ("none", "plain")]
    got = {r.k: r.t for r in spark.createDataFrame(rows, "k string, html string")
           .select("k", warc.html_text(F.col("html")).alias("t")).collect()}
    assert {t: got[t] for t in inline} == {t: "one word" for t in inline}
    assert {t: got[t] for t in block} == {t: "on\ne\nword" for t in block}
    assert got["named"] == "—é…Ω<p> '©"
    assert got["number"] == "’'\U0001f600é–\ufffd\ufffd\ufffd .'\ufffd"
    assert got["once"] == "&lt; &#38; &amp; &unknown; & &; &#; &#x; &amp &eacute R&D; a&b" and got["none"] == "plain"


def test_fingerprints_are_sparse_and_anchored(spark):
    rows = [(i, "\n".join(prose(50 * i + k, 4) for k in range(40))) for i in range(5)]
    rows += [(9, "\n".join(prose(k, 4) for k in range(10, 15))), (10, "\n".join(["same"] * 50)), (11, "a\n\nb"), (12, "a\nb")]
    every = line_dedup.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).checkpoint()
    # Each window once, whoever selected it; about one fingerprint for two windows.
    windows = line_dedup.extended(every).collect()
    assert len(windows) == len({(r.doc_id, tuple(r["at"])) for r in windows}) == 5 * 38 + 3 + 48 + 2
    assert every.where("doc_id < 9").count() < 0.6 * 5 * 38
    left = line_dedup.anchors(every).collect()
    assert {r.doc_id for r in left} == {0, 9, 10, 11, 12}
    # Equal runs select the same lines: what 9 shares with 0 is anchored there, and little else of 0.
    assert all(p in {r.print for r in left if r.doc_id == 0} for p in {r.print for r in left if r.doc_id == 9})
    assert len([r for r in left if r.doc_id == 0]) <= 4 and [list(r["at"]) for r in left if r.doc_id == 11] == [[0, 2]]


def test_long_runs_in_linear_time(spark):
    body = [prose(k, 3) for k in range(3000)]
    rows = [(1, "\n".join(body)), (2, "\n".join(x for k in range(0, 3000, 3) for x in [*body[k:k + 3], f"own {k}"])),
            (3, "\n".join(["same"] * 3000))]
    began = time.time()
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert time.time() - began < 60
    assert [got[k].n_removed for k in (1, 2, 3)] == [0, 3000, 2999]
    assert got[2].text.split("\n") == [f"own {k}" for k in range(0, 3000, 3)]


def test_no_sample_for_one_shard(spark, monkeypatch):
    points = spark.createDataFrame([(x,) for x in (1, 3, 7, 1 << 60)], "fp long")
    taken, arrow = [], type(points).toArrow
    monkeypatch.setattr(type(points), "toArrow", lambda df: taken.append(df) or arrow(df))
    edges = simhash.near_links(points, 3).collect()
    assert not taken and {x for e in edges for x in (e.u, e.v)} >= {1, 3, 7}
    simhash.near_links(points, 3, shard=2).collect()
    assert taken


def response(payload, mime="text/html", http="", **warc_headers):
    head = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in warc_headers.items())
    kind = f"Content-Type: {mime}\r\n" if mime else ""
    return (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:{len(payload)}>\r\n{head}\r\n"
            f"HTTP/1.1 200 OK\r\n{kind}{http}Server: s\r\n\r\n").encode() + payload


def test_source_digests_headers_and_payloads_that_are_no_text(spark):
    page = "<title>é</title><p>caf\xe9 \u2019 <b>x</b>"
    data = page.encode()
    sha1 = hashlib.sha1(data)
    base32 = base64.b32encode(sha1.digest()).decode()
    rows = {
        "b32": response(data, WARC_Payload_Digest=f"sha1:{base32}", WARC_IP_Address="1.2.3.4", WARC_Block_Digest="sha1:Q"),
        "hex": response(data, WARC_Payload_Digest=f"SHA1:{sha1.hexdigest().upper()}"),
        "sha256": response(data, WARC_Payload_Digest=f"sha256:{hashlib.sha256(data).hexdigest()}"),
        "md5": response(data, WARC_Payload_Digest=f"md5:{hashlib.md5(data).hexdigest()}"),
        "wrong": response(data, WARC_Payload_Digest=f"sha1:{'A' * 32}"),
        "other": response(data, WARC_Payload_Digest="blake3:00"), "absent": response(data),
        "png": response(b"\x89PNG\r\n\r\n\xff\x00<p>", "image/png"), "gzip": response(data, http="Content-Encoding: gzip\r\n"),
        "plain": response(b"a <b> c", "text/plain; charset=utf-8"), "json": response(b'{"a": "<p>"}', "application/ld+json"),
        "none": response(b"<p>a</p>b", ""), "latin": response("<p>café \u2019".encode("cp1252"), 'text/html; charset="ISO-8859-1"'),
        "broken": response(b"<p>a\xffb", "application/xhtml+xml; charset=utf-8")}
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in rows.items()], "k string, record binary")
    got = {(r.k, r.warc_type): r for r in warc.derive(df, keep=("k",)).collect()}
    meta = {k: got[k, "metadata"].block.split("\r\n") for k in rows}
    text = {k: got[k, "conversion"].block for k in rows if (k, "conversion") in got}
    match = {k: [x.split()[1] for x in m if x.startswith("digest-match")] for k, m in meta.items()}
    assert {k: match[k] for k in ("b32", "hex", "sha256", "md5", "wrong", "other", "absent")} == {
        "b32": ["true"], "hex": ["true"], "sha256": ["true"], "md5": ["true"], "wrong": ["false"], "other": [], "absent": []}
    assert {"warc-header: WARC-IP-Address: 1.2.3.4", f"source-payload-digest: sha1:{base32}", "source-block-digest: sha1:Q",
            "http-header: Server: s", "title: é"} <= set(meta["b32"])
    assert got["b32", "conversion"].source_digest == f"sha1:{base32}"
    assert got["absent", "metadata"].source_digest == "sha256:" + hashlib.sha256(data).hexdigest()
    assert set(text) == set(rows) - {"png", "gzip"}
    assert got["png", "metadata"].concurrent_to is None and not any(x.startswith("text-") for x in meta["png"])
    assert got["png", "metadata"].source_digest == "sha256:" + hashlib.sha256(b"\x89PNG\r\n\r\n\xff\x00<p>").hexdigest()
    assert text["b32"] == "é\ncafé \u2019 x" and text["plain"] == "a <b> c" and text["json"] == '{"a": "<p>"}'
    assert text["none"] == "a\nb" and text["latin"] == "café \u2019" and text["broken"] == "a\ufffdb"
    # Records of text give the same as those of bytes, where the bytes are UTF-8.
    same = {k: v.decode() for k, v in rows.items() if k not in ("png", "latin", "broken")}
    of_text = warc.derive(spark.createDataFrame(list(same.items()), "k string, record string"), keep=("k",)).collect()
    assert {(r.k, r.warc_type): r.record for r in of_text} == {k: r.record for k, r in got.items() if k[0] in same}
