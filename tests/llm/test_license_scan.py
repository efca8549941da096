import re

from shardload.llm import license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def base(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = [(i, label) for phrase, label in license_scan.PHRASES.items()
              for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return (len(words), len(places), min(at, default=None), max(at, default=None),
            ",".join(sorted({x for _, x in places})))


def test_base_and_method(spark):
    texts = [None, "", "Released under the MIT License.", "under the mit license under the mit license",
             "x Licensed under the Apache-License, Version 2.0. Licensed under CC BY-NC 4.0",
             "This work is licensed under the GNU General Public License, version 3.", "gnu public general license 3",
             "mit license", "É under the mit licensee", "cc by", "cc--by__nc",
             "filler " * 50 + "This work is licensed under the GNU General Public License, version 3.",
             "the license of mit", "released under the mit. license", "mit " * 3000 + "license"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r for r in license_scan.scan(df).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(t), t
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert got[5].labels == "gpl-3" and got[11].labels == "gpl-3" and got[6].labels == "" and got[12].labels == ""
    assert got[5].score == 1.0 and got[0].score == 0.0


def test_edges(edge_docs, no_docs):
    got = license_scan.scan(edge_docs).collect()
    assert len(got) == edge_docs.count() and max(r.n_words for r in got) == 250_000
    assert license_scan.scan(no_docs).count() == 0


def test_every_complete_key_phrase_is_found(spark):
    """Also without the rest of its notice, and whatever words no file has."""
    texts = ["Mozilla Public License v 2.0", "Redistribution and use in source and binary forms", "the permitted modification",
             "x cc by sa y", "GNU General Public License version 3 or, at your option", "public license mozilla v 2",
             "without the gnu general public license version 3 and mozilla public license v 2", "cc-by-nc", "by nc cc"]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    for i, t in enumerate(texts):
        words = " " + " ".join(WORD.findall(t.translate(LOWER))) + " "
        want = {label for label, (_, phrase) in license_scan.TEMPLATES.items() if f" {phrase} " in words}
        assert set(filter(None, got[i].labels.split(","))) == want, t
        assert (got[i].score > 0) == bool(want)
