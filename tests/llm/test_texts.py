"""Pages, licences, fingerprints, languages and archives."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from parcelforge.llm import html_layout, language_id, license_rules, order_minhash, warc
from parcelforge.llm.queries import QUERIES


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>a<p>b<br>c<br><br>d</p>x", "a\n\nb\nc\n\nd\n\nx"),
        ("<ul><li>one<ul><li>in<li>in2</ul><li>two</ul>", "- one\n  - in\n  - in2\n- two"),
        ("<ol start=3><li>x<li>y</ol>", "3. x\n4. y"),
        ("<table><caption>Cap</caption><tr><th>Name<th>Qty<tr><td>apple pie<td>3<tr><td colspan=2>wide cell</table>after", "Cap\nName       Qty\napple pie  3\nwide cell\n\nafter"),
        ("<div hidden>no</div><div style='DISPLAY : none'>no</div>yes &amp; <b>b</b>old <span> sp</span>", "yes & bold sp"),
        ("<pre>a\n  b\n\nc</pre>t", "a\n  b\n\nc\n\nt"),
        ("<title>t<b></title><body>x<script>var a='<p>';</script>y<style>p{}</style>", "xy"),
        ("<p>un<!-- c", "un"), ("<a href=\"x>y\">l</a><p title='>'>k", "l\n\nk"), ("<div>" * 3000 + "deep", "deep"), ("x < y & z <3 ok", "x < y & z <3 ok"), ("", ""), (None, ""),
        ("<head><title>t</title></head>body text", "body text"), ("<p>a&nbsp;&nbsp;b\n c</p></p>", "a b c"), ("<dl><dt>T<dd>D</dl>", "T\n  D"), ("plain", "plain"), ("<tr><td>a<td>b", "a b"),
    ],
)
def test_rendered_pages(page, text):
    assert html_layout.render(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<table><tr><form><td>a</td><td>b</td></form></tr></table>", "a  b"), ("<table><form><tr><td>a<td>b<tr><td>c</form></table>", "a  b\nc"),
        ("<table>one<tbody>two<tr>three<td>a</td>fo<b>u</b>r<td>b</tr>five</tbody>six</table>", "one\ntwo\nthree  a  four  b\nfive\nsix"),
        ("<table><tr><div>x<td>a</td>y</div></table>", "x  a  y"), ("<table><tr><div hidden><td>no</td></div><td>a</table>", "a"), ("<table><thead><p>t</p><tr><td>a</table>", "t\na"),
        ("<table><tr><td><table><tr>in<td>ner</table></td>x</table>", "in  ner  x"), ("<table><tr><td><input value=v></td><td>w</table>", "v  w"),
        ("see<svg><title>no</title><defs><text>no</text></defs><text>a</text><text>b</text></svg>c", "see a b c"), ("<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math>.", "x=1."), ("<table><tr><td><svg><text>a</text></svg><td>b</table>", "a  b"), ("<desc>shown</desc>", "shown"),
    ],
)
def test_text_of_malformed_tables_drawings_and_formulas(page, text):
    assert html_layout.render(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<table><tr><td><form><input type=submit value=Go></form></td></table>", "Go"), ("<div style='visibility:hidden'>no<b style='visibility: visible'>yes</b>no<i>no</i></div>", "yes"),
        ("<table><tr><td><ul><li>in1<li>in2</ul></td><td>b</table>", "- in1  b\n- in2"), ("<table><tr><td><pre>x\n y</pre><td>b</table>", "x   b\n y"), ("<table><tr><td>a<p>c</p><td>b</table>", "a  b\n\nc"),
        ("<table><tr><td rowspan=2>A<td>B<tr><td>C<tr><td>D<td>E</table>", "A  B\n   C\nD  E"), ("<table><tr><td colspan=3>wide<td>x<tr><td>1<td>2<td>3<td>4</table>", "wide     x\n1  2  3  4"),
        ("<table><tr><td colspan=100000>w<tr><td>1<td>2</table>", "w\n1  2"), ("<table><tr><td><table><tr><td>1<td>2<tr><td>33<td>4</table><td>z</table>", "1   2  z\n33  4"),
        ("<table><tr><td>" + "word " * 60 + "<td>r</table>", " ".join(["word"] * 24) + "  r\n" + " ".join(["word"] * 24) + "\n" + " ".join(["word"] * 12)),
        ("<b>" * 5000 + "<p>a</p>" + "</b>" * 5000 + "b", "a\n\nb"), ("<table><tr><td>" * 1500 + "deep" + "</table>" * 1500 + "after", "deep\n\nafter"),
    ],
)
def test_cells_are_laid_out_and_nothing_visible_is_lost(page, text):
    assert html_layout.render(page) == text


def test_deep_and_broken_pages_take_time_in_proportion():
    import time

    for page in ("<b><i>" * 20_000 + "x", "<div><p>" * 10_000 + "x", "<td>" * 20_000 + "x", "<table>" * 5000 + "x", "</p>" * 20_000 + "x", "<li><ul>" * 1000 + "x", "<table><tr>" + "<td rowspan=60000 colspan=900>y" * 60):
        began = time.process_time()
        assert html_layout.render(page).strip()
        assert time.process_time() - began < 20, page[:20]


def test_no_word_of_a_malformed_table_is_lost():
    import re

    r = random.Random(5)
    tags = ["<tr>", "<td>", "<th>", "</td>", "</tr>", "<tbody>", "<thead>", "</tbody>", "<form>", "</form>", "<div>", "</div>", "<b>", "</b>", "<p>", "<table>", "</table>", "<caption>", "</caption>", "<span>", "</span>"]
    for _ in range(2000):
        page = "<table>" + "".join(r.choice(tags) + (f" w{k} " if r.random() < 0.6 else "") for k in range(r.randrange(1, 25)))
        assert sorted(re.findall(r"w\d+", html_layout.render(page))) == sorted(re.findall(r"w\d+", page)), page


def test_all_paragraphs_of_the_pages_are_there(spark, sf_dir):
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in QUERIES["op4_html_layout"](spark, sf_dir).collect()}
    for r in pages.collect():
        body = re.sub(r"(?is)<(script|style|head)\b.*?</\1>|<!--.*?-->", " ", r["html"])
        words = html_layout.html.unescape(re.sub(r"<[^>]+>", " ", body)).split()
        shown = re.sub(r"(^|\n)\s*- ", "\n", got[r["page_id"]])
        assert "".join(words) == "".join(shown.split())


def test_pages_keep_columns(spark):
    df = spark.createDataFrame([(1, None, "old"), (2, "<p>x", "old")], "page_id int, html string, text string")
    out = html_layout.extract(df).orderBy("page_id").collect()
    assert [r["text"] for r in out] == ["", "x"] and html_layout.extract(df.limit(0)).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal.

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."""


@pytest.mark.parametrize(
    ("text", "names"),
    [
        (MIT, ["MIT"]), ("/* " + MIT.replace("\n", "\n * ") + " */", ["MIT"]), ("Hello. Released under the MIT License. Bye.", ["MIT"]), ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
        ("Licensed under CC BY 4.0.\nLicensed under the Apache License, Version 2.0", ["Apache-2.0", "CC-BY-4.0"]), ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0-only"]),
        ("Eclipse Public License - v 2.0", ["EPL-2.0"]), ("License: BSD-3-Clause", ["BSD-3-Clause"]), ("Licensed under the MPL 2.0.", ["MPL-2.0"]), ("Distributed under the Boost Software License, Version 1.0.", ["BSL-1.0"]),
        ("SPDX-License-Identifier: MIT", ["MIT"]), ("a license to kill", None), ("", None), (None, None),
    ],
)
def test_licences(spark, text, names):
    df = spark.createDataFrame([(text, "k")], "text string, licences string")
    found = license_rules.scan(df).collect()
    assert [list(r["licences"]) for r in found] == ([names] if names else [])


FULL_MIT = """MIT License

Copyright (c) 2020 A. Writer

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
FULL_BSD_3 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
   * Redistributions of source code must retain the above copyright notice,
     this list of conditions and the following disclaimer
   * Redistributions in binary form must reproduce the above copyright notice,
     this list of conditions and the following disclaimer in the documentation
     and/or other materials provided with the distribution
   * Neither the name of the copyright holder nor the names of its contributors
     may be used to endorse or promote products derived from this software
     without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES.
"""
MIT_IDS = ["mit-grant", "mit-condition", "as-is", "mit-liability"]
BSD_IDS = ["bsd-use", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is"]


@pytest.mark.parametrize("form", ["plain", "starred", "slashed", "crlf", "starred crlf", "one line", "cr"])
@pytest.mark.parametrize(("text", "ids", "names"), [(FULL_MIT, ["mit-notice", *MIT_IDS], ["MIT"]), (FULL_BSD_3, BSD_IDS, ["BSD-3-Clause"]), (FULL_MIT.partition("\n")[2], MIT_IDS, ["MIT"])])
def test_verbatim_licences_in_every_form(spark, text, ids, names, form):
    if "starred" in form:
        text = "/*\n" + "".join(f" * {line}".rstrip() + "\n" for line in text.splitlines()) + " */"
    elif form == "slashed":
        text = "".join(f"// {line}".rstrip() + "\n" for line in text.splitlines())
    elif form == "one line":
        text = " ".join(text.split())
    text = text.replace("\n", "\r\n") if "crlf" in form else text.replace("\n", "\r") if form == "cr" else text
    found = license_rules.scan(spark.createDataFrame([(text,)], "text string")).collect()
    assert [(r["licence_ids"], r["licences"]) for r in found] == [(ids, names)]


@pytest.mark.parametrize(
    ("text", "ids", "sentences"),
    [
        ("Dual: licensed under the Apache License, Version 2.0 or the MIT License.", ["apache-2-notice", "mit-notice"], 1),
        ("MIT license MIT license, ISC license", ["mit-notice", "mit-notice", "isc-notice"], 1),
        ("GNU General Public License version 2 or later", ["gpl-2-later"], 1), ("MIT License. ISC License.", ["mit-notice", "isc-notice"], 2), ("the MIT\n//\nlicense", None, 0), ("the MIT\r\nlicense", ["mit-notice"], 1),
    ],
)
def test_all_phrases_of_a_sentence(spark, text, ids, sentences):
    found = license_rules.scan(spark.createDataFrame([(text,)], "text string")).collect()
    assert [(r["licence_ids"], r["licence_sentences"]) for r in found] == ([(ids, sentences)] if ids else [])


def test_every_phrase_has_a_trigger_and_every_rule_known_identifiers():
    import re

    phrases, rules = license_rules.catalogue()
    assert all(re.search(license_rules.TRIGGER.replace("(?i)", ""), p) for p, _ in phrases)
    assert {i for _, seq in rules for i in seq} <= {i for _, i in phrases}


def test_order_minhash_edits(spark, sf_dir, small_docs):
    """Edited texts as by hand; equal texts have equal fingerprints; edits stay near, other texts don't."""
    texts = {r["doc_id"]: r["text"] or "" for r in small_docs.collect()}
    ids = sorted(texts)
    found = {r["doc_id"]: r for r in QUERIES["op2_order_minhash"](spark, sf_dir).collect()}
    seen: dict[str, set] = {}
    for k, i in enumerate(ids):
        t, other = texts[i], texts[ids[(k + 1) % len(ids)]]
        q = len(t) // 4
        edited = t[: len(t) - q] + other[:q]
        assert found[i]["n_chars"] == len(t) and found[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        seen.setdefault(t, set()).add(found[i]["fingerprint"])
    assert all(len(v) == 1 for v in seen.values())
    assert sum(r["near_edited"] for r in found.values()) / len(found) > 0.25 > 0.02 > sum(r["near_next"] for r in found.values()) / len(found)


def brute_signature(text, k, tuple_size, orders):
    """The same by definition: numbered k-mers, the least of each order, back in text order."""
    import struct

    import xxhash

    def chained(values):
        seed = 42
        for v in values:
            data = v.encode() if isinstance(v, str) else struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<q", v)
            seed = xxhash.xxh64(data, seed=seed).intdigest()
        return seed - (1 << 64) if seed >> 63 else seed

    parted = re.sub("[\u0800-\U0010ffff]", r" \g<0> ", text or "").strip(" \t\n\x0b\f\r")
    words = [chained([t]) for t in re.split("[ \t-\r]+", parted)] if parted else []
    mers = [(chained(words[i : i + k]) if k > 1 else words[i]) >> 28 for i in range(max(len(words) - k + 1, min(len(words), 1)))]
    seen, own = {}, []
    for h in mers:
        n = seen[h] = seen.get(h, -1) + 1
        own.append(chained([h, (n,)]) >> 28 if n else h)
    out = []
    for mask in order_minhash.masks(orders) if own else ():
        # By hash XOR mask as unsigned numbers, then by place; the mask has its first bit turned over.
        values = [x ^ (mask >> 28) for x in own]
        least = sorted(range(len(values)), key=lambda i: (values[i], i))[:tuple_size]
        taken = [values[i] for i in sorted(least)]
        if tuple_size == 2 and len(taken) == 1:
            taken *= 2
        out.append(chained(taken) & 0x7FFFFFFF)
    return out


@pytest.mark.parametrize(("k", "tuple_size", "orders"), [(2, 2, 32), (1, 3, 8), (3, 1, 5)])
def test_order_minhash_by_definition(make_docs, small_docs, k, tuple_size, orders):
    r = random.Random(1)
    texts = [" ".join(r.choice("abcdefgh") for _ in range(n)) for n in (1, 2, 3, 40, 700)] + [None, "", " \n\t", "one", "x " * 300, "a\tb\nc  d\x0be", "中文没有空格 and “quotes”—so", "\ud83c\udf89".encode("utf-16", "surrogatepass").decode("utf-16") * 3]
    texts += [x["text"] for x in small_docs.limit(15).collect()]
    found = order_minhash.signature(make_docs(texts), "text", "s", k=k, tuple_size=tuple_size, orders=orders).orderBy("doc_id").collect()
    assert [list(x["s"]) for x in found] == [brute_signature(t, k, tuple_size, orders) for t in texts]


def test_order_minhash_follows_edits_at_every_length(make_docs):
    """Texts just under and over any length are likened alike; order counts; clashing and repeated columns pass through."""
    r = random.Random(2)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    base = [r.choice(vocabulary) for _ in range(4000)]
    pairs = [(" ".join(base[:n]), " ".join(base[: n + 1])) for n in range(8, 16)] + [(" ".join(base), " ".join(base[:2000] + base[2100:])), (" ".join(base), " ".join(base[2000:] + base[:2000]))]
    docs = make_docs([t for pair in pairs for t in pair]).withColumnRenamed("source", "__s_words").withColumn("s", F.lit("old"))
    out = order_minhash.signature(docs, "text", "s").withColumn("f", order_minhash.fingerprint(F.col("s"))).orderBy("doc_id").collect()
    near = [sum(a == b for a, b in zip(x["s"], y["s"], strict=True)) / 32 for x, y in zip(out[::2], out[1::2], strict=True)]
    assert min(near[:8]) > 0.3 and near[8] > 0.8 and near[9] < near[8] and all(len(x["f"]) == 256 for x in out)


def test_next_rows(spark, make_docs):
    ids = [5, -3, 100, 7, 1 << 40, None]
    out = {r["doc_id"]: r["next_text"] for r in order_minhash.with_next(make_docs([(i, f"t{i}") for i in ids]), ["text"]).collect()}
    assert out == {-3: "t5", 5: "t7", 7: "t100", 100: f"t{1 << 40}", 1 << 40: "t-3", None: None}
    assert order_minhash.with_next(make_docs(["only"]), ["text"]).head()["next_text"] == "only"
    assert order_minhash.with_next(make_docs([]), ["text"]).count() == 0


def test_languages_on_held_out_texts(spark, sf_dir, small_docs):
    found = QUERIES["op10_language_id"](spark, sf_dir).join(small_docs, "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.95 * len(found) > 20
    assert all(0 <= r["score"] <= 1 for r in found)


def test_next_rows_of_long_ids(spark, make_docs):
    """Ids beyond what a double tells apart, with gaps, twice over, and none."""
    r = random.Random(9)
    ids = sorted({(1 << 60) + r.randrange(300) for _ in range(150)} | {-(1 << 62), 5})
    out = order_minhash.with_next(make_docs([(i, f"t{i}") for i in ids] + [(None, "x")]), ["text"], blocks=40).collect()
    expected = {i: f"t{ids[(k + 1) % len(ids)]}" for k, i in enumerate(ids)}
    assert {x["doc_id"]: x["next_text"] for x in out} == {**expected, None: None} and len(out) == len(ids) + 1


def test_machines_are_near_the_least_loss():
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(80, 3)).astype(np.float32)
    y = np.where(x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=80) * 0.4 > 0.2, 1, -1)
    loss = lambda w: 0.5 * (w @ w) + np.maximum(0, 1 - y * (x @ w[:-1] + w[-1])).sum()
    w = language_id.linear_svm(x, y, cost=1.0, epochs=300).astype(float)
    assert all(loss(w) <= loss(w + rng.normal(size=4) * step) * 1.001 for step in (0.3, 0.03, 0.003) for _ in range(100))
    rows = np.arange(0, 80, 2)
    assert np.allclose(language_id.linear_svm(x, y[rows], rows), language_id.linear_svm(x[rows], y[rows]))


def test_votes_and_ties_of_machines():
    """Three languages of one family by hand-made machines: most votes win, of equal votes the greatest sum of margins."""
    import numpy as np

    model = language_id.Model(["f", "g"], np.array([[1.0, -1.0], [0, 0], [0, 0], [0, 0]], np.float32), {"f": ["a", "b", "c"], "g": ["z"]}, {"f": np.array([[0, 0, 0], [1, 0, 0], [0, 1, 0], [0, 0, 1]], np.float32)[[0, 1, 2, 3]]})
    model.pairs["f"] = np.vstack([model.pairs["f"], np.zeros((1, 3), np.float32)])  # a-b, a-c, b-c by one number each
    model.family_weights = np.vstack([model.family_weights, np.zeros((1, 2), np.float32)])
    choose = lambda *x: model.predict(np.array(x, np.float32))[0]
    assert choose(1, 1, 1, 1) == "a" and choose(1, -1, 1, 1) == "b" and choose(1, 1, -1, -1) == "c" and choose(-1, 1, 1, 1) == "z"
    assert choose(1, 2, -1, 4) == "b" and choose(1, 3, -1, 2) == "a" and 0 <= model.predict(np.array([1, 2, -1, 3], np.float32))[1] < 0.5


def test_jumbled_letters_and_other_languages_are_not_known(spark, small_docs, make_docs):
    model = language_id.fit(small_docs)
    r = random.Random(3)
    jumbled = [" ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(2, 10))) for _ in range(n)) for n in (4, 30, 400)]
    other = ["Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.", "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.", "Все люди рождаются свободными и равными"]
    out = [x["lang_known"] for x in language_id.predict(make_docs([*jumbled, *other, None, "12"]), model).orderBy("doc_id").collect()]
    assert not any(out)
    assert language_id.predict(small_docs, model).where("lang_known").count() >= 0.99 * small_docs.count()
    many = spark.createDataFrame([(k, f"some text of language {k % 40}", f"l{k % 40}") for k in range(400)], "doc_id long, text string, lang string")
    assert set(language_id.fit(many, per_language=3).languages) == {f"l{k}" for k in range(40)}


def test_languages_of_odd_texts(make_docs):
    docs = make_docs([None, "", "12 34 !", "the cat and the dog"]).withColumn("lang_pred", F.lit("old"))
    out = [r["lang_pred"] for r in language_id.predict(docs, language_id.fit(docs)).orderBy("doc_id").collect()]
    assert out[:3] == ["und"] * 3 and out[3] in ("en", "und")
    assert [r["lang_pred"] for r in language_id.predict(docs, language_id.Model()).collect()] == ["und"] * 4
    assert language_id.predict(docs.limit(0), language_id.fit(docs.limit(0))).count() == 0


def test_warc_files_and_urls_with_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a/\r\nX: y", "é" * 700), (2, "http://b", None), (3, "http://c", "é" * 700)], "page_id long, url string, html string")
    records = warc.read_records(spark, warc.write_archive(df.withColumn("digest", F.lit("x")).withColumn("payload", F.lit(1))))
    parsed = {r["page_id"]: r for r in warc.parse_records(records).collect()}
    assert parsed[1]["target_uri"] == "http://a/%0D%0AX: y" and parsed[1]["record_type"] == "revisit" and parsed[1]["refers_to"] == 3
    warc.write_files(records.coalesce(1), str(tmp_path / "w"))
    data = next((tmp_path / "w").glob("part-*")).read_bytes()
    at, n = 0, 0
    while at < len(data):  # by the lengths that the headers tell
        head, _, rest = data[at:].partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1\r\n") and rest[length : length + 4] == b"\r\n\r\n"
        at, n = at + len(head) + 4 + length + 4, n + 1
    assert n == 3


def test_archive_round_trip(spark):
    long = "x" * 1500
    rows = [(1, "u1", long), (2, None, long), (3, "u\r\n3", "é"), (4, "u4", "é"), (5, "u5", None), (None, "u6", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    records = warc.read_records(spark, warc.write_archive(pages))
    found = {r["page_id"]: r for r in warc.parse_records(records).collect()}
    assert len(found) == 6 and found[2]["record_type"] == "response" and found[1]["record_type"] == "revisit" and found[1]["refers_to"] == 2 and found[None]["refers_to"] == 2
    assert bytes(found[3]["payload"]) == "é".encode() and found[4]["record_type"] == "response" and bytes(found[5]["payload"]) == b"" and found[2]["target_uri"] == ""
    whole = records.select(warc.record_bytes(F.col("header"), F.col("payload")).alias("r")).collect()
    assert all(bytes(r["r"]).startswith(b"WARC/1.1\r\n") and bytes(r["r"]).endswith(b"\r\n\r\n") for r in whole)
    assert warc.read_records(spark, warc.write_archive(pages.limit(0))).count() == 0


def test_stored_payloads_cross_the_network_once(spark):
    source = spark.createDataFrame([(1, b"a"), (2, b"a"), (2, b"a"), (None, b"b")], "id long, payload binary")
    groups = source.groupBy(F.unhex(F.sha2("payload", 256)).alias("digest")).agg(F.max("id").alias("first")).localCheckpoint()
    stored = warc._stored(source, groups)
    assert sorted(bytes(r["payload"]) for r in stored.collect()) == [b"a", b"b"]
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        assert warc._stored(source, groups)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
