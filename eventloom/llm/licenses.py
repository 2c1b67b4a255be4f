"""License scan: ordered signature rules over normalised words, with Spark functions only.

A text becomes its words in lower case, one blank apart. Rules are regexes over that line; each has
keywords, a literal part of every title or short name it may match, and runs only on texts that hold
one of them (most hold none of the stems that every match needs and cost one substring search per
stem). Each match is a detection with a place,
a rule, a priority and a score. A detection inside the place of one of higher priority, or of the
same priority and longer (equal places: earlier rule), is suppressed.

Rules come from the table of license families and from forms of naming one: an SPDX tag, a grant
("licensed under the ..."), a file notice, a full title with or without version, a short name next
to the word license. Base labels are found apart, as words in a row, and always stay.

Nulls: a null text is empty, a null doc_id keeps its row. Repeated rows are scanned each. Empty
tables give no rows; extra columns are ignored. Whole texts are scanned, in time linear in their
length for each rule that runs.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventloom.llm.common import documents, lower_ascii, written

_WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and labels of the contract.
BASE = {
    "gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit",
}

# Families (label, title as words, short names as words).
FAMILIES = [
    ("gpl", "gnu general public licen[sc]e|gnu gpl", "gpl ?v?[123]?|gplv[123]"),
    ("lgpl", "gnu (?:lesser|library) general public licen[sc]e", "lgpl ?v?[23]?"),
    ("agpl", "gnu affero general public licen[sc]e|affero general public licen[sc]e", "agpl ?v?3?"),
    ("gfdl", "gnu free documentation licen[sc]e", "gfdl"),
    ("apache", "apache (?:software )?licen[sc]e", "apache 2(?: 0)?|asl 2(?: 0)?"),
    ("mit", "(?:the )?mit licen[sc]e|expat licen[sc]e", "mit"),
    ("bsd", "bsd (?:[0234] clause )?licen[sc]e|(?:new|simplified|modified|original|revised) bsd licen[sc]e", "bsd(?: [0234] clause)?"),
    ("mpl", "mozilla public licen[sc]e", "mpl ?[12]?(?: [01])?"),
    ("epl", "eclipse public licen[sc]e", "epl ?[12]?(?: 0)?"),
    ("edl", "eclipse distribution licen[sc]e", "edl 1 0"),
    ("cddl", "common development and distribution licen[sc]e", "cddl ?1?(?: [01])?"),
    ("cpl", "common public licen[sc]e", "cpl 1 0"),
    ("cc-by-nc-nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?", "cc by nc nd(?: [1234] [05])?"),
    ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike", "cc by nc sa(?: [1234] [05])?"),
    ("cc-by-nc", "creative commons attribution non ?commercial", "cc by nc(?: [1234] [05])?"),
    ("cc-by-nd", "creative commons attribution no ?deriv(?:ative)?s?", "cc by nd(?: [1234] [05])?"),
    ("cc-by-sa", "creative commons attribution share ?alike", "cc by sa(?: [1234] [05])?"),
    ("cc-by", "creative commons attribution", "cc by(?: [1234] [05])?"),
    ("cc0", "creative commons zero|cc0 1 0 universal", "cc0(?: 1 0)?"),
    ("isc", "(?:the )?isc licen[sc]e", "isc"),
    ("zlib", "zlib (?:libpng )?licen[sc]e", "zlib"),
    ("libpng", "png reference library licen[sc]e|libpng licen[sc]e", "libpng 2 0"),
    ("artistic", "artistic licen[sc]e", "artistic 2 0"),
    ("perl", "same terms as perl(?: itself)?", "perl licen[sc]e"),
    ("wtfpl", "do what the fuck you want to public licen[sc]e", "wtfpl"),
    ("unlicense", "(?:the )?unlicense", "unlicense"),
    ("ofl", "sil open font licen[sc]e", "ofl 1 [01]"),
    ("bsl", "boost software licen[sc]e", "bsl 1 0"),
    ("busl", "business source licen[sc]e", "busl 1 1"),
    ("sspl", "server side public licen[sc]e", "sspl ?1?(?: 0)?"),
    ("elastic", "elastic licen[sc]e", "elastic 2 0"),
    ("psf", "python software foundation licen[sc]e", "psf ?2?(?: 0)?"),
    ("php", "php licen[sc]e", "php 3 0[01]?"),
    ("ruby", "ruby licen[sc]e", "ruby licen[sc]e"),
    ("eupl", "european union public licen[sc]e", "eupl ?1?(?: [012])?"),
    ("ms-pl", "microsoft public licen[sc]e", "ms pl"),
    ("ms-rl", "microsoft reciprocal licen[sc]e", "ms rl"),
    ("osl", "open software licen[sc]e", "osl [123] 0"),
    ("afl", "academic free licen[sc]e", "afl [123] [01]"),
    ("ecl", "educational community licen[sc]e", "ecl [12] 0"),
    ("ncsa", "university of illinois ncsa open source licen[sc]e", "ncsa"),
    ("openssl", "openssl licen[sc]e", "openssl"),
    ("qpl", "q public licen[sc]e", "qpl 1 0"),
    ("vim", "vim licen[sc]e", "vim licen[sc]e"),
    ("postgresql", "postgresql licen[sc]e", "postgresql licen[sc]e"),
    ("odbl", "open database licen[sc]e", "odbl ?1?(?: 0)?"),
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", "public domain"),
    ("proprietary", "all rights reserved", "proprietary and confidential"),
]

_VERSION = r"(?: (?:version|v|ver))? ?v?\d{1,2}(?: \d{1,2})?(?: or (?:any )?(?:later|newer))?"
#: Forms of naming a family: (pattern around title %t and short name %s, priority, score).
FORMS = [
    (r"spdx licen[sc]e identifier (?:%s)(?: only| or later)?", 5, 1.0),
    (r"(?:licen[sc]ed|released|distributed|available|redistribute(?:d)?|modify it|made available) (?:it )?under (?:the )?(?:terms of )?(?:the )?(?:%t)(?:%v)?", 5, 0.95),
    (r"(?:licen[sc]ed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?(?:%s)(?:%v)?(?: licen[sc]e)?", 4, 0.9),
    (r"(?:%t)%v", 3, 0.8),
    (r"(?:%t)", 2, 0.6),
    (r"licen[sc]e (?:is |type |name )?(?:%s)", 1, 0.4),
]
#: Every match of a rule and every base phrase holds one of these: the first, cheap search.
STEMS = ("licen", "cc by", "public domain", "all rights reserved", "creative commons", "gnu gpl", "cc0", "same terms as perl", "wtfpl",
         "released under", "distributed under", "available under")

_OPTION = re.compile(r"\|(?![^()]*\))")
_NOT_LITERAL = re.compile(r"\(\?:[^()]*\)\??|\[[^]]*\]\??|[a-z0-9 ]\?")


def _keywords(names: str) -> list[str]:
    """A literal part of each alternative of ``names``: the longest, rather not of the word license alone."""
    parts = (_NOT_LITERAL.split(name) for name in _OPTION.split(names))
    return list(dict.fromkeys(max(own, key=lambda x: (x.strip() != "licen" and len(x) > 1, len(x))) for own in parts))


def rules() -> list[dict]:
    """Signature rules in order: families by forms, each behind the keywords of its titles or short names."""
    out = []
    for label, title, short in FAMILIES:
        for form, priority, score in FORMS:
            body = form.replace("%t", title).replace("%s", short).replace("%v", _VERSION)
            named = _keywords(title if "%t" in form else short)
            out.append({"rule": len(out), "keywords": named, "regex": rf"(?<![^ ])(?:{body})(?![^ ])",
                        "priority": priority, "label": label, "score": score})
    return out


def _rules_column() -> Column:
    kind = "array<struct<rule:int,keywords:array<string>,regex:string,priority:int,label:string,score:double>>"
    return F.from_json(F.lit(json.dumps(rules())), kind)


def _places(line: Column, phrase: str) -> Column:
    """Word numbers at which the words of ``phrase`` stand in a row; occurrences may share words."""
    words, parts = F.col("words"), phrase.split(" ")
    at = F.filter(F.transform(words, lambda w, i: F.when(w == parts[0], i)), lambda i: i.isNotNull())
    here = lambda i: [F.get(words, i + k).eqNullSafe(p) for k, p in enumerate(parts)]

    def follows(i: Column) -> Column:
        found = here(i)
        for f in found[1:]:
            found[0] = found[0] & f
        return found[0]

    return F.when(F.contains(line, F.lit(phrase)), F.filter(at, follows)).otherwise(F.array().cast("array<int>"))


def scanned(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, places, hits) of every text: base places by phrase, raw detections."""
    text = lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    rows = rows.withColumn("words", F.filter(F.split("text", _WORD_BREAK), lambda w: w != "")).drop("text")
    rows = rows.withColumn("line", F.array_join("words", " "))
    gate = F.lit(False)
    for stem in STEMS:
        gate = gate | F.contains("line", F.lit(stem))
    rows = rows.withColumn("line", F.when(gate, F.col("line")).otherwise(""))
    places = F.array(*(F.struct(F.lit(label).alias("label"), _places(F.col("line"), phrase).alias("at")) for phrase, label in BASE.items()))
    none = F.array().cast("array<struct<rule:int,priority:int,label:string,score:double,k:int,gap:int,length:int>>")
    return rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("long").alias("n_words"),
        F.when(F.col("line") == "", F.array().cast("array<struct<label:string,at:array<int>>>")).otherwise(places).alias("places"),
        F.when(F.col("line") == "", none).otherwise(_hits(F.col("line"))).alias("hits"))


def _hits(line: Column) -> Column:
    """Matches of all rules of which a keyword is in ``line``: per rule the ``k``-th match, the characters
    between it and the one before, and its length."""
    chosen = F.filter(_rules_column(), lambda r: F.exists(r["keywords"], lambda k: F.contains(line, k)))

    def matches(r: Column) -> Column:
        found = F.regexp_extract_all(line, r["regex"], F.lit(0))
        spans = F.arrays_zip(F.split(line, r["regex"]).alias("before"), found.alias("match"))
        placed = F.transform(spans, lambda s, k: F.struct(
            r["rule"].alias("rule"), r["priority"].alias("priority"), r["label"].alias("label"), r["score"].alias("score"),
            k.alias("k"), F.length(s["before"]).alias("gap"), F.length(s["match"]).alias("length")))
        return F.filter(placed, lambda m: m["length"].isNotNull())  # what follows the last match

    return F.flatten(F.transform(chosen, matches))


def detections(scan: DataFrame) -> DataFrame:
    """(row, doc_id, rule, priority, label, score, start, end) that no other detection suppresses."""
    rows = scan.select("row", "doc_id", F.explode("hits").alias("h")).select("row", "doc_id", "h.*")
    of_rule = Window.partitionBy("row", "rule").orderBy("k")
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(of_rule))
    rows = rows.withColumn("start", F.col("end") - F.col("length")).drop("k", "gap", "length")
    # Whatever holds a place comes before it in this order.
    order = Window.partitionBy("row").orderBy(
        F.col("start"), F.desc("end"), F.desc("priority"), "rule").rowsBetween(Window.unboundedPreceding, -1)
    levels = sorted({p for _, p, _ in FORMS})
    for p in levels:
        rows = rows.withColumn(f"reach{p}", F.max(F.when(F.col("priority") >= p, F.col("end"))).over(order))
    reach = F.coalesce(*(F.when(F.col("priority") == p, F.col(f"reach{p}")) for p in levels))
    rows = rows.withColumn("reach", reach).where("reach is null or reach < end")
    return rows.drop("reach", *(f"reach{p}" for p in levels))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row."""
    scan = written(scanned(docs), "license-scan")
    found = detections(scan).groupBy("row").agg(F.collect_set("label").alias("found"), F.max("score").alias("best"))
    rows = scan.drop("hits").join(found, "row", "left")
    at = F.flatten(F.transform("places", lambda p: p["at"]))
    base = F.transform(F.filter("places", lambda p: F.size(p["at"]) > 0), lambda p: p["label"])
    rows = rows.withColumn("at", at).withColumn("base", base)
    every = F.array_union("base", F.coalesce("found", F.array().cast("array<string>")))
    text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return rows.select(
        "doc_id", "n_words", F.size("at").cast("long").alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"), F.array_max("at").cast("long").alias("last_word"),
        text(F.col("base")).alias("base_labels"), text(every).alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.size("base") > 0, 0.5).otherwise(0.0)).alias("score"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))
