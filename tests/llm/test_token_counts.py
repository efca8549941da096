import json
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shardload.llm import token_counts as T

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = T.Counter(PATH)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def quadratic(symbols, ranks):
    """Merges the pair of lowest rank, the left one of equal pairs, until none has a rank."""
    s = list(symbols)
    while True:
        best = min(((ranks[p], i) for i, p in enumerate(zip(s, s[1:])) if p in ranks), default=None)
        if best is None:
            return len(s)
        i = best[1]
        s[i:i + 2] = [s[i] + s[i + 1]]


@pytest.mark.parametrize("seed", range(20))
def test_heap_merging_against_a_plain_loop(seed):
    rnd = random.Random(seed)
    symbols = {"a", "b", "c"}
    ranks = {}
    for r in range(12):
        pair = (rnd.choice(sorted(symbols)), rnd.choice(sorted(symbols)))
        if pair not in ranks:
            ranks[pair] = r
            symbols.add(pair[0] + pair[1])
    for _ in range(50):
        text = "".join(rnd.choice("abc") for _ in range(rnd.randrange(40)))
        assert T.merged_length(text, ranks) == quadratic(text, ranks)


def test_every_character_near_every_kind():
    chars = [chr(c) for c in (*range(0x300), *range(0x1680, 0x1682), *range(0x2000, 0x2070), 0x3000, 0x3042, 0x4e2d, 0xfeff, 0x1f600)]
    for c in chars:
        for text in (c, f"a{c}b", f"1{c}2", f" {c} x", f"{c}{c}  {c}\n", f"'{c}s"):
            assert OWN.count(text) == library(text), ascii(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ab Z'sTl19²éÿ \n\t\x1c\x85 ’,.<|>"), st.characters(exclude_categories=["Cs"]))))
def test_random_texts(text):
    assert OWN.count(text) == library(text)


def test_added_tokens_and_long_runs():
    for text in ("<|endoftext|>", "a <|endoftext|> b", "<|endoftext|><|endoftext|>x", "<|endoftext", " <|endoftext|>\n \n"):
        assert OWN.count(text) == library(text)
    rnd = random.Random(1)
    run = "".join(rnd.choice("etaoinshrdlu") for _ in range(200_000))
    assert OWN.count(run) == library(run)
    assert OWN.count("é" * 30_001) == library("é" * 30_001)


def test_cache_generations(monkeypatch):
    monkeypatch.setattr(T, "CACHE_PIECES", 5)
    own = T.Counter(PATH)
    words = [f"{a}{b}word" for a in "xyz" for b in "qrst"]
    for text in words + words[::-1] + [" ".join(words)]:
        assert own.count(text) == library(text)


def test_edges(edge_docs, no_docs):
    rows = edge_docs.collect()
    got = T.token_counts(edge_docs, PATH, limit=3).collect()
    want = [(r.doc_id, len((r.text or "").encode()), library(r.text), library(r.text) > 3) for r in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert T.token_counts(no_docs, PATH).count() == 0


def test_other_vocabularies_are_refused(tmp_path, edge_docs):
    spec = json.load(open(PATH))
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}},
                   {"added_tokens": [dict(spec["added_tokens"][0], lstrip=True)]},
                   {"model": dict(spec["model"], ignore_merges=True)}, {"model": dict(spec["model"], vocab={})}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps(spec | change))
        with pytest.raises(ValueError):
            T.token_counts(edge_docs, str(path))
