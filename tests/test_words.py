"""Unicode word breaking: cases by rule, and random texts against another implementation of the rules."""

import random

import pytest
import regex
from pyspark.sql import functions as F

from conftest import lines_df
from shardload.operators.postings import MAX_TOKEN, WORD_PATTERN, _latin_word, _word_pattern, word_tokens

# Fixed cases, by rule of Annex 29: text -> words.
CASES = {
    "Don't stop": ["don't", "stop"], "it’s o.k. e.g. x": ["it’s", "o.k", "e.g", "x"],
    "3.14 1,000;2 1.a a.1 3..4 .5": ["3.14", "1,000;2", "1", "a", "a", "1", "3", "4", "5"],
    "a:b a_b __ _x_ x__9,5": ["a:b", "a_b", "_x_", "x__9,5"], "A1b2 2nd": ["a1b2", "2nd"],
    "été á'b ñ_̃o": ["été", "á'b", "ñ_̃o"],
    "so­ft zero‍width a​b": ["so­ft", "zero‍width", "a", "b"],
    "צה\"ל ג' ג'ג": ["צה\"ל", "ג'", "ג'ג"],
    "日本語 こん カタカナー abcア_ア": [
        "日", "本", "語", "こ", "ん", "カタカナー", "abc", "ア_ア"],
    "한국어 a한": ["한국어", "a한"], "สวัสดี x": ["สวัสดี", "x"],
    "١٫٢ १": ["١٫٢", "१"], "Ⅷ Ⓐ x² ½": ["ⅷ", "ⓐ", "x"],
    "a@b.com http://x.y/z?q=1": ["a", "b.com", "http", "x.y", "z", "q", "1"], "": [], " .,;' ": [], "''a''": ["a"],
}


def words_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return {r.i: r.w for r in df.select("i", word_tokens(F.col("t")).alias("w")).collect()}


def test_cases(spark):
    got = words_of(spark, CASES)
    for i, (text, want) in enumerate(CASES.items()):
        assert got[i] == want, (ascii(text), got[i], want)


def other(text):
    """Words by the boundaries of the ``regex`` module; a piece counts if it holds a letter or number."""
    parts = regex.split(r"(?wV1)\b", text)
    return [p.lower() for p in parts if regex.search(r"[\p{Alphabetic}\p{Nd}]", p)]


@pytest.mark.parametrize("seed", range(4))
def test_random_texts_against_another_implementation(spark, seed):
    rnd = random.Random(seed)
    # no colon (a mid letter in older versions of the rules only), no script without spaces (dictionaries there), no
    # vowels (the other one breaks between an apostrophe and a vowel), no format characters (it does not look past them)
    letters = "bZßñאבкカ漢あ한19٣\u0301"
    marks = "'''..,;_’·‧\" -@"
    texts = ["".join(rnd.choice(letters if rnd.random() < 0.6 else marks) for _ in range(rnd.randrange(1, 24))) for _ in range(1500)]
    # an accent on no letter, or before a mark (past which the other one does not look either)
    texts = [t for t in texts if not regex.search(f"(^|[^\\w])\u0301|\u0301[{marks}]", t)]
    got = words_of(spark, texts)
    wrong = [(ascii(t), got[i], other(t)) for i, t in enumerate(texts) if got[i] != other(t)]
    assert not wrong, wrong[:3]


def test_long_runs_and_long_tokens(spark):
    n = 300_000
    texts = ["a" * n, "1." * n, "a'" * n, "_a" * n, "́" * n, "a" + "́" * n, "'" * n, "ア" * n, "漢" * 2000, None]
    got = words_of(spark, texts)
    assert got[9] is None
    for i, t in enumerate(texts[:9]):
        assert max(map(len, got[i]), default=0) <= MAX_TOKEN
        keep = regex.sub(r"[^\p{Alphabetic}\p{N}]", "", t)
        assert regex.sub(r"[^\p{Alphabetic}\p{N}]", "", "".join(got[i])) == keep  # no letter is lost
    assert [len(x) for x in got[0]] == [MAX_TOKEN] * (n // MAX_TOKEN) + [n % MAX_TOKEN]


def extracted(spark, texts, **patterns):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    return [(r, texts[r.i]) for r in df.select("i", *[F.regexp_extract_all("t", F.lit(p), 0).alias(k) for k, p in patterns.items()]).collect()]


@pytest.mark.parametrize("seed", range(3))
def test_latin_words_are_those_of_the_whole_rules(spark, seed):
    """The short pattern for ASCII and Latin letters comes first; the result is that of the whole rules."""
    rnd = random.Random(seed)
    letters = "abZßñéÀÿĀŁɏÖª µ×÷09_" + "אבкカ漢あ19٣́­‍\U0001F3FB\U0001D400ไ"
    marks = "'''..,,;;::_\"’·‧-@\n\t \x00\x7f "
    texts = ["".join(rnd.choice(letters[:rnd.choice((12, 20, len(letters)))] if rnd.random() < 0.7 else marks)
                     for _ in range(rnd.randrange(1, 30))) for _ in range(3000)]
    texts += [(c * 300 + t) for t in ("", "x", "é", "カ", ".é") for c in ("1.", "a'", "_a", "a", "a:é")]
    wrong = [(ascii(t), r.now, r.whole) for r, t in extracted(spark, texts, now=WORD_PATTERN, whole=_word_pattern()) if r.now != r.whole]
    assert not wrong, wrong[:3]


def test_every_character_alone_and_between_letters(spark):
    texts = [f"{c} a{c}b 1{c}2 _{c}" for c in map(chr, [*range(0x3100), *range(0xA640, 0xD7FF, 7), *range(0xE000, 0x10000), *range(0x10000, 0x20000, 5)])]
    wrong = [ascii(t) for r, t in extracted(spark, texts, now=WORD_PATTERN, whole=_word_pattern()) if r.now != r.whole]
    assert not wrong, wrong[:3]


def test_plain_words_are_taken_by_the_short_pattern(spark):
    """No word of ASCII or Latin letters alone is left to the whole rules."""
    texts = ["don't stop 3.14 1,000;2 a:b _x_ x__9,5", "für été b.com", "a.カ aカ"]
    got = {t: r.short for r, t in extracted(spark, texts, short=_latin_word())}
    assert got[texts[0]] == ["don't", "stop", "3.14", "1,000;2", "a:b", "_x_", "x__9,5"]
    assert got[texts[1]] == ["für", "été", "b.com"] and got[texts[2]] == []


def test_the_index_of_a_build(spark, scratch):
    from shardload.plans.build import shard_docs
    from shardload.plans.publish import publish, read_current_part
    from shardload.plans.search import search, words
    docs = shard_docs(lines_df(spark, ["1\tt:I don't pay 3.14", "2\tt:don t pay 3 14"]), "i", shards=2)
    for analyzer, want in (("standard", {"1": {"i", "don't", "pay", "3.14"}, "2": {"don", "t", "pay", "3", "14"}}),
                           ("plain", {"1": {"i", "don", "t", "pay", "3", "14"}, "2": {"don", "t", "pay", "3", "14"}})):
        root = f"{scratch}/{analyzer}"
        publish(docs, root, shards=2, with_postings=True, analyzer=analyzer)
        got = {}
        for r in read_current_part(spark, root, "postings").collect():
            got.setdefault(r["_id"], set()).add(r["term"])
        assert got == want
        hits = sorted(r["_id"] for r in search(spark, root, *words(spark, "t", "DON'T", analyzer)).collect())
        assert hits == (["1"] if analyzer == "standard" else ["1", "2"])
