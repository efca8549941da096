"""Personal data by bootstrapped contextual extraction.

Four kinds have a fixed form (e-mail, IPv4, payment card, phone) and are the
seed entities; so are, as ``id``, long tokens of mixed letters and digits that stand
behind a key (``name = …``, ``name: …``, ``name=…``).  Every seed, and every other token
with a digit or an at sign, is an instance; the words next to it and a ``key=`` within
it are its lexical patterns.  Spark scores the graph of patterns and instances in
rounds.  An instance is judged if it is a seed or if the round before found it; a
pattern's confidence for a kind is the mean over its judged distinct instances, with
those not judged counted as wrong in part (``UNKNOWN``) and one more as wrong; an
instance's is what its patterns leave unlikely not to be.  Patterns with enough judged
instances and confidence then name what stands next to them and has no fixed form, as
their kind, or ``id`` if only the kinds together reach it.  A token behind a key is named
by its pattern only: the seed rule alone adds no span.

Defined results: a null text is empty (no spans, the hash of ''); spans are code
points, end exclusive; spans found by pattern never overlap a seed; repeated
rows are read each for itself; extra columns are ignored; texts are read whole,
in time linear in their length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardload.llm.common import saved, small

KINDS = ("email", "ip", "card", "phone")
OTHER = "id"
ROUNDS, MIN_SUPPORT, MIN_CONFIDENCE = 3, 5, 0.8
#: Weight of an instance that is not judged.
UNKNOWN = 0.5
#: Shape of a secret: its length, and how many letters, digits and different characters it has at least.
SECRET_LENGTH, SECRET_MIX, SECRET_CHARACTERS = (16, 512), 3, 8

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]+")
_TOKEN = re.compile(r"\S+")
_WORD = re.compile(r"\w")
_HINT = re.compile("[0-9@]")
_KEY = re.compile(r"([A-Za-z_]{1,32}[=:])(?=.)")
_EDGE = ".,;:!?()[]{}<>\"'#$%&*|"
_SECRET = re.compile(r"[A-Za-z0-9+/=_-]+\Z")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their at signs: a match must begin with the whole
    run of local characters before one (so far as it is not part of a match)."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _EMAIL.match(text, start) if start < at else None
        if m:
            yield m.span()
            done = m.end()
        at = text.find("@", max(done, at + 1))


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _chains(text: str, runs: list[tuple[int, int]], between: str) -> Iterator[list[tuple[int, int]]]:
    """Maximal chains of digit runs with one character of ``between`` in each gap."""
    chain: list[tuple[int, int]] = []
    for run in runs:
        if chain and not (run[0] == chain[-1][1] + 1 and text[chain[-1][1]] in between):
            yield chain
            chain = []
        chain.append(run)
    if chain:
        yield chain


def _ips(text: str, runs: list) -> Iterator[tuple[int, int]]:
    for chain in _chains(text, runs, "."):
        for k in range(0, len(chain) - 3, 4):  # matches do not overlap; one that fails is used up
            parts = [text[a:b].lstrip("0") for a, b in chain[k:k + 4]]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                yield chain[k][0], chain[k + 3][1]


def _cards(text: str, runs: list) -> Iterator[tuple[int, int]]:
    for chain in _chains(text, runs, " -"):
        if 12 <= sum(b - a for a, b in chain) <= 19 and _luhn("".join(text[a:b] for a, b in chain)):
            yield chain[0][0], chain[-1][1]


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m.group())) <= 15:
            yield m.span()


def seeds(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of all base matches, in order."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    runs = [m.span() for m in _DIGITS.finditer(text)]
    if runs:
        found += [(a, 1, b) for a, b in _ips(text, runs)] + [(a, 2, b) for a, b in _cards(text, runs)]
        if "+" in text:
            found += [(a, 3, b) for a, b in _phones(text)]
    return sorted(found)


def _short(s: str) -> str:
    s = s.lower().strip(_EDGE)
    return s if len(s) <= 40 else hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def _secret(token: str) -> bool:
    """A long token of mixed letters and digits."""
    letters, digits = sum(map(str.isalpha, token)), sum(map(str.isdigit, token))
    return (SECRET_LENGTH[0] <= len(token) <= SECRET_LENGTH[1] and min(letters, digits) >= SECRET_MIX
            and len(set(token.lower())) >= SECRET_CHARACTERS and _SECRET.match(token) is not None)


def instances(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int | None, int, list[str]]]:
    """``(start, end, kind number or None, hash of the instance, patterns)``."""
    if not _HINT.search(text):
        return []
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    out, b, covered = [], 0, 0
    for k, (s, e) in enumerate(tokens):
        own = []
        while b < len(base) and base[b][0] < e:
            own.append(base[b])
            covered = max(covered, base[b][2])
            b += 1
        if not own:
            if s < covered or not _HINT.search(text, s, e):
                continue
            while s < e and text[s] in _EDGE:
                s += 1
            while e > s and text[e - 1] in _EDGE:
                e -= 1
            if s < e:
                own = [(s, None, e)]
        before = [_short(text[x:y]) for x, y in tokens[max(0, k - 2):k]]
        behind_key = k > 0 and text[tokens[k - 1][1] - 1] in "=:"
        for s, kind, e in own:
            # marks alone are no context
            patterns = ["1 " + before[-1]] if before and _WORD.search(before[-1]) else []
            if len(before) == 2 and _WORD.search(" ".join(before)):
                patterns.append("2 " + " ".join(before))
            after = next((_short(text[x:y]) for x, y in tokens[k + 1:k + 2] if x >= e), None)
            if after and _WORD.search(after):
                patterns.append("> " + after)
            key = _KEY.match(text, tokens[k][0], tokens[k][1])
            if key and key.end() < e:
                patterns.append("= " + key.group(1).lower())
                if kind is None:
                    s = max(s, key.end())
                    while s < e - 1 and text[s] in _EDGE:
                        s += 1
            if kind is None and (behind_key or key) and _secret(text[s:e]):
                kind = len(KINDS)
            value = hashlib.blake2b(text[s:e].encode("utf-8", "surrogatepass"), digest_size=8).digest()
            out.append((s, e, kind, int.from_bytes(value, "little", signed=True), patterns))
    return out


_SPAN = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())])
_INSTANCE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("value", pa.int64()),
                       ("patterns", pa.list_(pa.string()))])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base = [seeds(t or "") for t in batch.column(1).to_pylist()]
        found = [instances(t or "", b) for t, b in zip(batch.column(1).to_pylist(), base)]
        yield pa.RecordBatch.from_arrays([
            batch.column(0),
            pa.array([[{"start": a, "rank": k, "end": e} for a, k, e in b] for b in base], pa.list_(_SPAN)),
            pa.array([[dict(zip(("start", "end", "kind", "value", "patterns"), x)) for x in f] for f in found],
                     pa.list_(_INSTANCE))], ["doc_id", "base", "found"])


def trusted(found: DataFrame, rounds: int = ROUNDS, support: int = MIN_SUPPORT,
            confidence: float = MIN_CONFIDENCE, unknown: float = UNKNOWN) -> DataFrame:
    """``(pattern, rank)``: the patterns to trust.  ``found``: ``(value, kind, pattern)``, a row per
    occurrence of an instance beside a pattern; a value is of a kind if it is so anywhere."""
    n = len(KINDS) + 1
    seeds_of = found.where("kind IS NOT NULL").groupBy("value").agg(F.max("kind").alias("kind"))
    edges = saved(found.select("pattern", "value").distinct().join(seeds_of, "value", "left"), "pii-edges")
    scored = edges.select("pattern", F.col("kind").isNotNull().alias("judged"),
                          *[F.when(F.col("kind") == k, 1.0).otherwise(0.0).alias(f"s{k}") for k in range(n)])
    for r in range(rounds):
        judged = F.count(F.when(F.col("judged"), 1))
        weight = judged + unknown * (F.count(F.lit(1)) - judged) + 1
        conf = scored.groupBy("pattern").agg(judged.alias("support"), *[
            (F.sum(F.when(F.col("judged"), F.col(f"s{k}")).otherwise(0.0)) / weight).alias(f"c{k}") for k in range(n)])
        conf = saved(conf.where(F.col("support") >= support), f"pii-patterns{r}")
        if r + 1 == rounds:
            break
        lift = edges.where("kind IS NULL").join(conf, "pattern").groupBy("value").agg(
            *[(1 - F.exp(F.sum(F.log1p(-F.col(f"c{k}"))))).alias(f"v{k}") for k in range(n)])
        lift = lift.where(F.greatest(*[F.col(f"v{k}") for k in range(n)]) >= confidence)  # the instances found
        scored = edges.join(lift, "value", "left").select(
            "pattern", (F.col("kind").isNotNull() | F.col("v0").isNotNull()).alias("judged"), *[
                F.when(F.col("kind") == k, 1.0).when(F.col("kind").isNull(), F.coalesce(f"v{k}", F.lit(0.0))).otherwise(0.0)
                .alias(f"s{k}") for k in range(n)])
    best = F.greatest(*[F.col(f"c{k}") for k in range(n)])
    rank = F.when(best < confidence, n - 1)
    for k in range(n):
        rank = rank.when(F.col(f"c{k}") == best, k)
    total = sum((F.col(f"c{k}") for k in range(n)), F.lit(0.0))
    return conf.where(total >= confidence).select("pattern", rank.cast("int").alias("rank"))


def _text(spans: Column) -> Column:
    name = F.array(*map(F.lit, (*KINDS, OTHER)))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.get(name, x["rank"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base, spans)`` for every row;
    ``base`` and ``spans`` are arrays of ``(start, rank, end)``, rank in KINDS
    (and OTHER) order: the fixed forms, and these with what patterns add."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = (f"doc_id {source.schema['doc_id'].dataType.simpleString()}, "
              "base array<struct<start:int,rank:int,end:int>>, "
              "found array<struct<start:int,end:int,kind:int,value:bigint,patterns:array<string>>>")
    rows = saved(source.mapInArrow(_read, schema).withColumn("row", F.monotonically_increasing_id()), "pii")
    one = rows.where(F.size("found") > 0).select("row", F.explode("found").alias("x")).select(
        "row", "x.start", "x.end", "x.kind", "x.value", F.explode("x.patterns").alias("pattern"))
    trust = small(saved(trusted(one.select("value", "kind", "pattern")), "pii-trusted"))
    more = (one.where(F.coalesce("kind", F.lit(len(KINDS))) == len(KINDS)).join(trust, "pattern").groupBy("row", "start", "end").agg(F.min("rank").alias("rank"))
            .groupBy("row").agg(F.collect_list(F.struct("start", "rank", "end")).alias("more")))
    of = lambda k: F.size(F.filter("base", lambda x: x["rank"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return rows.drop("found").join(more, "row", "left").select(
        "doc_id", *[of(k) for k in range(len(KINDS))], "base",
        F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more")).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """``base`` as ``base_sha256`` and ``spans`` as text."""
    return found.withColumn("base_sha256", F.sha2(_text(F.col("base")).cast("binary"), 256)).withColumn(
        "spans", _text(F.col("spans"))).drop("base")
