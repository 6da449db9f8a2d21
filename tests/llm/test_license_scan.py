import random
import re
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from barlake.llm import license_scan as scan
from barlake.llm.queries import registered

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = []
    for phrase, label in scan.BASE_PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({x for _, x in places}))
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), labels)


def labels(text):
    return [d[0] for d in scan.detect(text.lower())]


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("Released under the MIT License.", ["mit"]),
        ("Licensed under the Apache License,\n Version 2.0.", ["apache-2.0"]),
        ("licensed under the GNU General Public License, version 3.", ["gpl-3.0"]),
        ("Licensed under CC BY-NC 4.0.", ["cc-by-nc-4.0"]),
        ("SPDX-License-Identifier: GPL-2.0-or-later", ["gpl-2.0"]),
        ("https://creativecommons.org/licenses/by-sa/3.0/", ["cc-by-sa-3.0"]),
        ("All rights reserved. BSD 2-Clause License", ["all-rights-reserved", "bsd-2-clause"]),
        ("a limited driver's licence for the mitten", []),
        ("", []),
    ],
)
def test_detections(text, wanted):
    assert labels(text) == wanted


def every_regex(text):
    return scan.kept_detections((r, m.start(), m.end()) for r in scan.rules() for m in r.pattern.finditer(text))


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("available under Creative Commons\nAttribution 4.0 International", ["cc-by-4.0"]),
        ("released under CC0 1.0", ["cc0-1.0"]),
        ("distributed under the GNU GPL v3", ["gpl-3.0"]),
        ("published under CC BY-SA 4.0", ["cc-by-sa-4.0"]),
        ("available to anyone under the terms of the Mozilla  Public", ["mpl"]),
        ("covered by Expat", ["mit"]),
        ("licensed under the GNU General\n Public License, version 3", ["gpl-3.0"]),
    ],
)
def test_statements_without_the_word_license(spark, text, wanted):
    assert labels(text) == wanted
    docs = spark.createDataFrame([(1, "word " * 500 + text)], "doc_id long, text string")
    assert [d["label"] for d in scan.scan(docs).first()["detections"]] == wanted


def test_equals_running_every_regex_over_the_whole_text():
    rng = random.Random(4)
    parts = (
        "licensed released available provided under by through to anyone the terms of subject license licence licensing "
        "is : = type name ' spdx-license-identifier: mit expat mit/x11 apache software 2.0 , version v 3 gnu gpl general "
        "public lgpl-3.0 lesser affero bsd 2-clause new zero mozilla mpl 2 creative commons attribution non-commercial "
        "share alike 4.0 international cc by-nc by-sa 4.0 cc0 1.0 unlicense no without any domain in dedicated copyleft "
        "all rights reserved proprietary non-commercial use only creativecommons.org/licenses/by/4.0 word other"
    ).split()
    found = 0
    for _ in range(1500):
        text = "".join(p + rng.choice(["", " ", " ", " ", "\n", "  \n "]) for p in rng.choices(parts, k=60))
        assert scan.detect(text) == every_regex(text)
        assert not scan.detect(text) or any(g in text for g in scan.GATES)
        found += len(scan.detect(text))
    assert found > 1500


def test_contained_detections_are_suppressed_and_places_are_right():
    pad = "x" * 1000 + " "
    found = scan.detect(pad + "licensed under the apache license, version 2.0, or the mit license " + pad)
    assert [(d[0], d[4]) for d in found] == [("apache-2.0", 90), ("mit", 60)]
    assert all(d[2] >= 1001 and d[3] <= 1070 for d in found)


def test_hundreds_of_rules_in_order():
    rules = scan.rules()
    assert len(rules) > 300
    assert [r.priority for r in rules] == sorted((r.priority for r in rules), reverse=True)


def test_rows(spark):
    texts = [None, "", "MIT license mit License", "the general, public\nlicense", "word " * 50_000 + "Apache-License", "MIT"]
    docs = spark.createDataFrame([Row(doc_id=i, text=t, n_words="x") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    docs = docs.union(docs.filter("doc_id = 2"))
    rows = scan.scan(docs).withColumn("starts", F.col("base.start")).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        n, count, first, last, _ = brute(texts[r["key"]])
        assert (r["n_words"], len(r["starts"])) == (n, count)
        assert (min(r["starts"], default=None), max(r["starts"], default=None)) == (first, last)
    assert scan.scan(docs.limit(0)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = {d["doc_id"]: d["text"] for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = registered()["op2_license_scan"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert tuple(r)[1:6] == brute(docs[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert (r["score"] > 0) == bool(r["labels"]) and 0 <= r["score"] <= 1
    assert {"mit", "apache-2.0", "gpl-3.0", "cc-by-nc-4.0"} <= {x for r in rows for x in r["labels"].split(",")}


def test_suppression_equals_a_plain_version_and_takes_many_matches():
    def rule(number, priority):
        return scan.Rule(number, str(number), None, priority, None)

    def plain(matches):
        found = sorted(((-r.priority, s - e, s, r.number, e, r) for r, s, e in matches), key=lambda f: f[:5])
        kept = []
        for _, _, s, _, e, r in found:
            if not any(a <= s and e <= b for _, _, a, b, _ in kept):
                kept.append((r.label, r.number, s, e, r.priority))
        return sorted(kept, key=lambda d: (d[2], d[3], d[1]))

    rng = random.Random(1)
    for _ in range(200):
        matches = []
        for n in range(rng.randrange(25)):
            start = rng.randrange(30)
            matches.append((rule(n, rng.choice([50, 70, 90])), start, start + rng.randrange(1, 12)))
        assert scan.kept_detections(matches) == plain(matches)
    many = [(rule(n % 600, 50 + n % 40), 7 * n, 7 * n + 20) for n in range(100_000)]
    begun = time.process_time()
    assert scan.kept_detections(many)
    assert time.process_time() - begun < 10
