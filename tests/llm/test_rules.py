import random
import re
from collections import Counter

import pytest

from eventloom.llm import html_text, licenses, quality
from tests.llm.conftest import ODD


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\f\r")]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_base_counts(table):
    rng = random.Random(8)
    made = ["".join(rng.choices(["a ", "b ", "é", "#", "|x ", "\n", "\t", "日 "], k=rng.randint(0, 80))) for _ in range(120)]
    texts = ODD + made + ["a b c d e " * 3, "x\nx\n\nx"]
    found = {r.doc_id: tuple(r)[2:] for r in quality.base_counts(table(texts)).collect()}
    assert [found[k] for k in range(len(texts))] == [counts(t) for t in texts]


def test_verdicts(spark, table, monkeypatch):
    monkeypatch.setattr(quality, "PRIOR", 1.0)  # a few hundred n-grams in all
    good = ["the quick brown fox jumps over lazy dogs near old river banks today " + f"n{k}" for k in range(30)]
    junk = ["the$$$ quick%%% brown### fox&&& jumps*** over||| lazy$$$ dogs%%% near### old&&& river " + f"j{k}" for k in range(10)]
    docs = table(good + junk + [None, "few words", "a b c d e f " * 30])
    labels = spark.createDataFrame([(k, 1, 0) for k in range(20)] + [(None, 1, 0), (35, None, 0)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    assert all(found[k].kept for k in range(30)) and not any(found[k].kept for k in range(30, 43))
    assert [found[k].base_failed for k in (0, 30, 40, 41, 42)] == [False, False, True, True, True]
    assert found[40].score == 0.0
    none = quality.judge(docs, labels.where("false")).collect()
    assert all(r.score == 0.0 for r in none) and sum(r.kept for r in none) == 40
    assert quality.judge(table([]), labels).count() == 0


def base_places(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text) if w]
    at, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        here = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        at += here
        labels |= {label} if here else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_license_base(table):
    rng = random.Random(3)
    parts = ["GNU General", "Public", "License", "apache", "MIT", "cc", "BY", "x", "-", "\n", ".", "é", "general public license"]
    texts = ODD + [" ".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(150)]
    found = {r.doc_id: tuple(r)[1:6] for r in licenses.scan_licenses(table(texts)).collect()}
    assert [found[k] for k in range(len(texts))] == [base_places(t) for t in texts]
    assert licenses.scan_licenses(table([])).count() == 0


@pytest.mark.parametrize("text, labels", [
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"),
    ("SPDX-License-Identifier: LGPL-3.0-only", "lgpl"),
    ("Released under the GNU Lesser General Public License, version 3 or later", "lgpl"),
    ("under the Apache License, Version 2.0 and the MIT License", "apache,mit"),
    ("A permit is licensed by the summit.", ""),
    ("Copyright me. All rights reserved.", "proprietary"),
])
def test_license_labels(table, text, labels):
    (row,) = licenses.scan_licenses(table([text])).collect()
    assert row.labels == labels and (row.score > 0) == bool(labels) and row.score <= 1


def examples(rng, pattern):
    """A text that the pattern matches; alternatives, options and characters by chance."""
    def one(parts):
        out = ""
        for op, arg in parts:
            kind = str(op)
            if kind == "LITERAL":
                out += chr(arg)
            elif kind == "IN":
                of, value = rng.choice(arg)
                out += {"LITERAL": chr, "RANGE": lambda v: chr(rng.randint(*v)), "CATEGORY": lambda v: rng.choice("0123")}[str(of)](value)
            elif kind == "MAX_REPEAT":
                out += "".join(one(arg[2]) for _ in range(rng.randint(arg[0], arg[1])))
            elif kind == "SUBPATTERN":
                out += one(arg[3])
            elif kind == "BRANCH":
                out += one(rng.choice(arg[1]))
            else:
                assert kind == "ASSERT_NOT"
        return out

    return one(re._parser.parse(pattern))


def test_license_gates_drop_no_match(table):
    """Every rule finds its examples behind stems and keywords as it does alone."""
    rng, rules = random.Random(6), licenses.rules()
    assert all(len(k) > 1 for r in rules for k in r["keywords"])
    texts = [examples(rng, r["regex"]) for r in rules for _ in range(10)]
    alone = [re.compile(r["regex"]) for r in rules]
    found = {r.doc_id: {h.rule for h in r.hits} for r in licenses.scanned(table(texts)).collect()}
    for k, text in enumerate(texts):
        assert k // 10 in found[k], text
        assert found[k] == {n for n, r in enumerate(alone) if r.search(text)}, text


@pytest.mark.parametrize("text, label", [
    ("Licensed under the GNU GPL v3", "gpl"), ("Creative Commons Attribution 4.0", "cc-by"), ("SIL Open Font License 1.1", "ofl"),
    ("released under the MIT", "mit"), ("Expat License", "mit"), ("distributed under BSD", "bsd"), ("license: ASL 2.0", "apache"),
])
def test_license_titles_without_short_names(table, text, label):
    (row,) = licenses.scan_licenses(table([text])).collect()
    assert row.labels == label


def test_license_suppression(table):
    scan = licenses.scanned(table(["licensed under the gnu lesser general public license version 2 1 or later"]))
    rows = licenses.detections(scan).collect()
    raw = scan.collect()[0].hits
    assert len(raw) > len(rows) and {r.label for r in rows} == {"lgpl"}
    assert all(not (a != b and a.start <= b.start and a.end >= b.end and a.priority >= b.priority) for a in rows for b in rows)
    assert len(licenses.rules()) >= 200


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("  plain\n text ", "plain text"),
    ("<p>a<p>b", "a\n\nb"), ("a<br>b<br><br>c", "a\nb\n\nc"), ("x<div>y</div>z", "x\ny\nz"),
    ("<ul><li>a<li>b<ol start=9><li>c<li>d</ol><li>e</ul>", "- a\n- b\n  9. c\n  10. d\n- e"),
    ("<table><tr><th>name<th>n<tr><td>longer<td>1</table>", "name    n\nlonger  1"),
    ("<pre>a\n  b</pre>", "a\n  b"), ("<b>a</b><i>b</i> c", "ab c"),
    ("<head><title>t</title></head><body>x<script>'</p>'</script><!-- c -->", "x"),
    ("<p hidden>a</p><p style='display: none'>b</p><p>c", "c"),
    ("<span style='visibility:hidden'>a<b>b</b></span>c", "c"),
    ("&lt;b&gt; &amp; &eacute;", "<b> & é"), ("a < b and c<d", "a < b and c"), ("<dl><dt>t<dd>d", "t\n  d"),
    ("</div></p>x</b>", "x"), ("<textarea> a\n b</textarea>", " a\n b"), ("<blockquote>q</blockquote>", "  q"),
    ("<table><tr><td>a<table><tr><td>b<td>c</table><td>d</table>", "a b  c  d"),
])
def test_visible_text(page, text):
    assert html_text.visible_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<head><title>T</title><p>Hello", "Hello"), ("<html><head><meta charset=x><link rel=y>Hello <b>you</b>", "Hello you"),
    ("<head><title>T</title>\n <script>s</script><noscript><p>n</p></noscript><style>c</style>\n<div>x</div>y", "x\ny"),
    ("<head><title>T</title>&nbsp;x", "\xa0x"), ("<head><template><p>n</template><x-y>z", "z"),
    ("<head><title>T</title></head><p>a", "a"), ("<head>\n<!-- c --><title>T</title><body>a", "a"),
])
def test_content_ends_an_open_head(page, text):
    assert html_text.visible_text(page) == text


def test_visible_text_of_hostile_pages():
    assert html_text.visible_text("<div>" * 100_000 + "x") == "x"
    assert html_text.visible_text("<a '" * 20_000) == ""
    assert html_text.visible_text("<p" * 50_000) == ""
    assert html_text.visible_text("<li>" * 30_000 + "x").endswith("x")
    assert len(html_text.visible_text("<table>" + "<tr><td>" + "y" * 50_000 + "<tr><td>z<td>z" * 2000)) < 400_000


def test_extract_text(spark):
    rows = [(1, "u", "<p>a", 9), (None, None, None, 9), (1, "u", "<p>a", 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    assert sorted((r.page_id or 0, r.text) for r in html_text.extract_text(pages).collect()) == [(0, ""), (1, "a"), (1, "a")]
    assert html_text.extract_text(pages.where("false")).count() == 0


def test_patterns_name_characters_one_by_one(table):
    """Java tests the ranges of a class one after the other, for each character."""
    import re

    for pattern in (quality._TOKEN, quality._NO_BLANK, quality.BLANKS):
        assert "-" not in pattern
    text = "".join(f"{chr(k)}x{chr(k)}{chr(k)}" for k in [*range(1, 0x250), 0x3042, 0x1F600])
    plain = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[!-/:-@\[-`{-~]+"
    found = table([text]).select(quality._tokens(quality.F.col("text"))).first()[0]
    assert found == re.findall(plain, text)
