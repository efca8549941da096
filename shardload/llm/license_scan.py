"""Licence scan with a positional rare-token index (DataFrame functions only).

Every text is cut into words once.  Exact phrases give the base labels.  For
the rest, template words are posted with their positions; a file's own
highest-IDF template words are looked up, postings that agree on the relative position are
intersected, and a label is given only where the template's mandatory key
phrase stands complete at that position.

Defined results: a null text counts as empty (0 words, no label, score 0);
repeated rows are scanned each for itself; extra columns are ignored; words,
places and labels cover whole texts.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardload.llm.common import lower_ascii, saved, small

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrase and label of the base scan.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Label -> (template notice, mandatory key phrase, a part of it).
TEMPLATES = {
    "mit": ("released under the mit license", "mit license"),
    "apache-2": ("licensed under the apache license version 2 0", "apache license version 2"),
    "cc-by-nc": ("licensed under cc by nc 4 0", "cc by nc"),
    "gpl-3": ("this work is licensed under the gnu general public license version 3",
              "gnu general public license version 3"),
    "mpl-2": ("this source code form is subject to the terms of the mozilla public license v 2 0",
              "mozilla public license v 2"),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted",
            "redistribution and use in source and binary forms"),
    "cc-by-sa": ("licensed under cc by sa 4 0", "cc by sa"),
}

#: Highest-IDF words of a template in a file that are looked up there, and how many must agree.  As
#: many words of its key phrase are always among them, so every complete key phrase is reached.
RARE_WORDS, MIN_RARE = 4, 2


def _template_words(spark: SparkSession, templates: dict) -> DataFrame:
    """``(label, word, tpos, in_phrase, phrase_len, template_len)``."""
    rows = []
    for label, (notice, phrase) in templates.items():
        w, p = notice.split(), phrase.split()
        at = next(i for i in range(len(w)) if w[i:i + len(p)] == p)
        rows += [(label, x, i, at <= i < at + len(p), len(p), len(w)) for i, x in enumerate(w)]
    return spark.createDataFrame(rows, "label string, word string, tpos int, in_phrase boolean, "
                                       "phrase_len int, template_len int")


def _words_in(spaced):
    """Words of a string in which every word stands between two spaces of its own."""
    return ((F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))) / 2).cast("long")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: dict | None = None,
         templates: dict | None = None) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` per row of ``docs``."""
    spark = docs.sparkSession
    phrases, templates = phrases or PHRASES, templates or TEMPLATES
    index = _template_words(spark, templates)
    vocabulary = sorted({w for notice, _ in templates.values() for w in notice.split()})
    keys = sorted({w for _, phrase in templates.values() for w in phrase.split()})

    # One pass over the texts: words, base places, template words with positions.
    d = docs.select(F.col(doc_id).alias("doc_id"),
                    F.regexp_extract_all(lower_ascii(F.col(text)), F.lit(WORD), F.lit(0)).alias("words"))
    d = d.select("doc_id", "words", F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" ")).alias("s"),
                 F.array_intersect("words", F.array(*map(F.lit, vocabulary))).alias("present"))
    found = []
    for phrase, label in phrases.items():
        p = F.lit(" " + "  ".join(phrase.split()) + " ")
        n = ((F.length("s") - F.length(F.replace(F.col("s"), p, F.lit("")))) / F.length(p)).cast("long")
        found.append(F.when(F.col("s").contains(p), F.struct(
            n.alias("n"),
            _words_in(F.substring_index(F.col("s"), " " + "  ".join(phrase.split()) + " ", 1)).alias("first"),
            (F.size("words") - len(phrase.split()) - _words_in(
                F.substring_index(F.col("s"), " " + "  ".join(phrase.split()) + " ", -1))).cast("long").alias("last"),
            F.lit(label).alias("label"))))
    at = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("pos"))),
                  lambda x: x.word.isin(vocabulary))
    hits = F.when(F.arrays_overlap("present", F.array(*map(F.lit, keys))), at)
    d = d.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("long").alias("n_words"),
                 F.filter(F.array(*found), lambda x: x.isNotNull()).alias("base"), "present", hits.alias("hits"))
    d = saved(d, "licence-words")

    # IDF of the template words over all documents (one count per word).  In files with all words of
    # a key phrase, the rarest words of that template among those of the file are looked up.
    total = d.count()
    df = {r.word: r.n for r in d.select(F.explode("present").alias("word")).groupBy("word")
          .agg(F.count(F.lit(1)).alias("n")).collect()}
    idf = {w: math.log((total + 1) / (df.get(w, 0) + 1)) for w in vocabulary}
    rarest = lambda text: sorted(set(text.split()), key=lambda w: (-idf[w], w))
    words = lambda ws: F.array(*map(F.lit, ws))
    wanted = []
    for label, (notice, phrase) in templates.items():
        key = rarest(phrase)
        least = min(MIN_RARE, len(key))
        of_file = F.slice(F.array_intersect(words(rarest(notice)), "present"), 1, RARE_WORDS)
        wanted.append(F.when(F.size(F.array_intersect(words(key), "present")) == len(key), F.struct(
            F.lit(label).alias("label"), F.lit(least).alias("least"),
            F.array_union(words(key[:MIN_RARE]), of_file).alias("words"))))
    index = F.broadcast(index)

    # Postings of these words that agree on where the template would start.
    looked_up = F.filter("hits", lambda x: F.array_contains("wanted.words", x.word))
    starts = (d.where(F.col("hits").isNotNull())
              .select("row", "hits", F.explode(F.filter(F.array(*wanted), lambda x: x.isNotNull())).alias("wanted"))
              .select("row", "wanted.label", "wanted.least", F.explode(looked_up).alias("hit"))
              .select("row", "label", "least", "hit.word", "hit.pos").join(index, ["label", "word"])
              .groupBy("row", "label", "least", (F.col("pos") - F.col("tpos")).alias("at"))
              .agg(F.count(F.lit(1)).alias("n_rare")).where(F.col("n_rare") >= F.col("least")).drop("least"))
    starts = small(saved(starts, "licence-starts"))

    # There, all words of the template are compared; the key phrase must be complete.
    places = (d.where(F.col("hits").isNotNull()).select("row", "hits").join(starts, "row")
              .select("row", "label", "at", F.explode("hits").alias("hit"))
              .select("row", "label", "at", "hit.word", (F.col("hit.pos") - F.col("at")).alias("tpos"))
              .join(index, ["label", "word", "tpos"])
              .groupBy("row", "label", "at")
              .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("in_phrase").cast("int")).alias("n_phrase"),
                   F.first("phrase_len").alias("phrase_len"), F.first("template_len").alias("template_len"))
              .where(F.col("n_phrase") == F.col("phrase_len")))
    matched = places.groupBy("row").agg(F.collect_set("label").alias("more"),
                                        F.max(F.col("n") / F.col("template_len")).alias("best"))
    base = F.array_sort(F.array_distinct(F.transform("base", lambda x: x.label)))
    both = F.array_sort(F.array_union(base, F.coalesce("more", F.array().cast("array<string>"))))
    return d.join(matched, "row", "left").select(
        "doc_id", "n_words", F.coalesce(F.aggregate("base", F.lit(0).cast("long"), lambda a, x: a + x.n),
                                        F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["last"])).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"))
