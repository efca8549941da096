"""Inverted index as DataFrames.

Postings are kept in long form — one row per (field, term, shard, document)
with the term frequency and positions — never as one array per term: a
frequent term would otherwise put a posting list the size of the corpus into
one row.  Per-term statistics are plain counts over that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: a token is a maximal run of letters and digits (an
# approximation of Unicode word breaking), taken from the lower-cased text.
TOKEN_PATTERN = "[\\p{L}\\p{N}]+"

# The English stop words of the default analyzer.
ENGLISH_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no", "not", "of",
    "on", "or", "such", "that", "the", "their", "then", "there", "these", "they", "this", "to", "was", "will", "with",
)


def tokens_of(text: Column) -> Column:
    """``array<string>`` of the tokens of a text."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


# The character classes of Unicode word breaking (Annex 29), as Java regex classes.
# Marks and format characters belong to what stands before them (Extend, Format, ZWJ).
_EXTEND = r"\p{M}\u200C\u200D\uFF9E\uFF9F\x{1F3FB}-\x{1F3FF}[\p{Cf}&&[^\u200B]]"
_COMPLEX = (r"[\p{IsThai}\p{IsLao}\p{IsMyanmar}\p{IsKhmer}\p{IsTai_Le}\p{IsNew_Tai_Lue}\p{IsTai_Tham}\p{IsTai_Viet}&&[\p{L}]]")
_KATAKANA = r"[\p{IsKatakana}&&[^\uFF9E\uFF9F]]\u3031-\u3035\u309B\u309C\u30A0\u30FC\uFF70"
_LETTER = (r"[\p{IsAlphabetic}&&[^\p{IsIdeographic}\p{IsHiragana}" + _KATAKANA + r"\p{M}" + _COMPLEX + r"\p{Nd}\uFF9E\uFF9F]]"
           r"\u02C2-\u02C5\u02D2-\u02D7\u02DE\u02DF\u02ED\u02EF-\u02FF")
_HEBREW = r"[\p{IsHebrew}&&[\p{Lo}]]"
_NUMERIC = r"\p{Nd}\u066B"
_JOINER = r"\p{Pc}\u202F"
_MID_ANY = r".\u2018\u2019\u2024\uFE52\uFF07\uFF0E'"
_MID_LETTER = _MID_ANY + r":\u00B7\u0387\u05F4\u2027\uFE13\uFE55\uFF1A"
_MID_NUMBER = _MID_ANY + r",;\u037E\u0589\u060C\u060D\u066C\u07F8\u2044\uFE10\uFE14\uFE50\uFE54\uFF0C\uFF1B"
#: Longest token; what is longer is cut there.  Also the most parts that a token is joined of.
MAX_TOKEN = 255


def _word_pattern() -> str:
    """The rules as one automaton: a token begins with joiners and a run of letters and numbers or of katakana, and goes
    on over joiners, over one mark between two letters or two numbers, and over the quotes inside Hebrew words;
    an ideograph or hiragana stands alone, a run of a script without spaces is one token.  A run is one possessive
    step, whatever its length, and the number of steps is bounded, so no text exhausts the stack."""
    c = lambda x: f"[{x}]"
    more = lambda x: f"[{x}{_EXTEND}]*+"
    rest = more("")
    alnum, kana = c(_LETTER + _NUMERIC) + more(_LETTER + _NUMERIC), c(_KATAKANA) + more(_KATAKANA)
    after = lambda x: f"(?<=[{x}][{_EXTEND}]{{0,8}})"
    tail = more(_LETTER + _NUMERIC)
    steps = [c(_JOINER) + more(_JOINER) + f"(?:{alnum}|{kana})?+",
             after(_LETTER) + c(_MID_LETTER) + rest + c(_LETTER) + tail,
             after(_NUMERIC) + c(_MID_NUMBER) + rest + c(_NUMERIC) + tail,
             after(_HEBREW) + '"' + rest + c(_HEBREW) + tail]
    word = f"(?:{c(_JOINER)}{more(_JOINER)})?+(?:{alnum}|{kana})(?:{'|'.join(steps)}){{0,{MAX_TOKEN}}}+(?:{after(_HEBREW)}'{rest})?+"
    return "|".join([word, r"[\p{IsHan}\p{IsIdeographic}\p{IsHiragana}]" + rest, _COMPLEX + more(_COMPLEX)])


def _latin_word() -> str:
    """``_word_pattern`` where it meets nothing but ASCII and Latin letters, whose classes are short lists of characters:
    the same steps, as often at most.  What follows must not be, or begin after one mark, a character beyond these."""
    letter = "".join(map(chr, [*range(65, 91), *range(97, 123), *(c for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))])) + "\u0100-\u024F"
    number, other = "0123456789", f"[^\\x00-\\x7F{letter}]"
    tail = f"[{letter}{number}]*+"
    steps = [f"_++{tail}", f"(?<=[{letter}])[.':][{letter}]{tail}", f"(?<=[{number}])[.',;][{number}]{tail}"]
    return f"_*+[{letter}{number}]{tail}(?:{'|'.join(steps)}){{0,{MAX_TOKEN}}}+(?!{other}|[.':,;]{other})"


#: ASCII characters that no token begins with.
_NO_START = "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum() and chr(c) != "_")
WORD_PATTERN = f"(?![{_NO_START}])(?:{_latin_word()}|{_word_pattern()})"


def word_tokens(text: Column) -> Column:
    """D1, standard analysis: the words of a text by Unicode word breaking, lower-cased, cut after ``MAX_TOKEN``
    characters.  ``don't`` and ``3.14`` are one token each; a mark or space alone is none."""
    def cut(t: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.length(t) - 1) / MAX_TOKEN).cast("int"))
        return F.when(F.length(t) <= MAX_TOKEN, F.array(t)).otherwise(
            F.transform(starts, lambda k: F.substr(t, k * MAX_TOKEN + 1, F.lit(MAX_TOKEN))))
    words = F.regexp_extract_all(text, F.lit(WORD_PATTERN), 0)
    return F.flatten(F.transform(words, lambda t: cut(F.lower(t))))


#: Analyses by name: ``plain`` takes runs of letters and digits, ``standard`` breaks words as Unicode does.
ANALYZERS = {"plain": tokens_of, "standard": word_tokens}


def tokenize(df: DataFrame, text_col: str, keep: tuple[str, ...] = ("_doc", "_id", "shard_id"),
             field: str | None = None, stop_words: DataFrame | None = None, analyzer: str = "plain") -> DataFrame:
    """One row per token: ``keep…, field, position, term``.

    Positions count every token, so removing stop words leaves gaps as a
    stop filter does.  ``stop_words`` (column ``term``) is an anti-join, which
    the optimizer broadcasts if the list is small.
    """
    keep = tuple(c for c in keep if c in df.columns)
    out = df.select(*keep, F.lit(field or text_col).alias("field"),
                    F.posexplode(ANALYZERS[analyzer](F.col(text_col))).alias("position", "term"))
    out = out.withColumn("position", F.col("position").cast("int"))
    if stop_words is not None:
        out = out.join(stop_words.select("term"), "term", "left_anti")
    return out


def string_values(docs: DataFrame, keep: tuple[str, ...] = ("_doc", "_id", "shard_id")) -> DataFrame:
    """String fields of parsed documents in long form ``keep…, field, pos, value``."""
    keep = tuple(c for c in keep if c in docs.columns)
    return (docs.select(*keep, F.explode(F.filter("fields", lambda x: x["type"] == "string")).alias("f"))
            .select(*keep, F.col("f.name").alias("field"), F.col("f.pos").alias("pos"), F.col("f.str").alias("value")))


def analyze_fields(docs: DataFrame, keep: tuple[str, ...] = ("_doc", "_id", "shard_id"),
                   stop_words: tuple[str, ...] = (), analyzer: str = "plain") -> DataFrame:
    """D1 over every string field of parsed documents.  The values of a field
    continue its position count; stop words leave gaps.

    The one shuffle moves values, not tokens: the running position needs a
    document's field together, and the postings' grouping is satisfied by that."""
    vals = string_values(docs, keep)
    keep = tuple(c for c in keep if c in vals.columns)
    before = F.sum(F.size("tokens")).over(
        Window.partitionBy("_doc", "field").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    rows = vals.withColumn("tokens", ANALYZERS[analyzer](F.col("value"))).withColumn("before", F.coalesce(before, F.lit(0)))
    out = (rows.select(*keep, "field", "before", F.posexplode("tokens").alias("position", "term"))
           .select(*keep, "field", (F.col("before") + F.col("position")).cast("int").alias("position"), "term"))
    return out.where(~F.col("term").isin(*stop_words)) if stop_words else out


def postings(tokens: DataFrame, by_shard: bool = True) -> DataFrame:
    """``(field, term, [shard_id,] _doc, _id, tf, positions)`` — one row
    per term and document.  Tokens of one document sit in one partition, so
    the partial aggregation collapses repeats before the shuffle."""
    keys = ["field", "term"] + (["shard_id"] if by_shard and "shard_id" in tokens.columns else [])
    return (tokens.groupBy(*keys, "_doc", "_id")
            .agg(F.count(F.lit(1)).alias("tf"), F.array_sort(F.collect_list("position")).alias("positions")))


def term_stats(post: DataFrame, by_shard: bool = False) -> DataFrame:
    """D3: document frequency and total term frequency per term."""
    keys = ["field", "term"] + (["shard_id"] if by_shard else [])
    return post.groupBy(*keys).agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf"))


def _in_row_counts(all_keys: Column) -> Column:
    """``array<struct<key, df, ttf>>``: every distinct key once for its document
    and every key once for itself, ready for one aggregation."""
    def rows(keys: Column, df: int, ttf: int) -> Column:
        return F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit(df).alias("df"), F.lit(ttf).alias("ttf")))
    return F.concat(rows(F.array_distinct(all_keys), 1, 0), rows(all_keys, 0, 1))


def term_counts(df: DataFrame, text_col: str, keep: tuple[str, ...] = (), analyzer: str = "plain") -> DataFrame:
    """D3 from texts, without postings: ``(field, term, keep…, df, ttf)``.  A
    document's terms are told apart inside the row (a hash set of strings), so
    the only shuffle moves partial sums per term."""
    tokens = F.explode(F.array(ANALYZERS[analyzer](F.col(text_col)))).alias("t")
    return (df.select(*keep, tokens).select(*keep, F.explode(_in_row_counts(F.col("t"))).alias("r"))
            .groupBy(F.lit(text_col).alias("field"), F.col("r.key").alias("term"), *keep)
            .agg(F.sum("r.df").alias("df"), F.sum("r.ttf").alias("ttf")))


NUMERIC = ("integer", "long", "short", "float", "double")


def whole(x: Column) -> Column:
    """The value of an integral field as BIGINT."""
    return F.coalesce(x["l"], x["i"].cast("bigint"), x["s"].cast("bigint"))


def real(x: Column) -> Column:
    """The value of a float or double field as DOUBLE (a float widens exactly)."""
    return F.coalesce(x["d"], x["f"].cast("double"))


def negative_zero(c: Column) -> Column:
    return (c == 0.0) & c.cast("string").startswith("-")


def numeric_postings(docs: DataFrame, keep: tuple[str, ...] = ("_doc", "_id", "shard_id")) -> DataFrame:
    """D4 with documents: ``(field, type, whole, real, neg_zero, keep…, tf)``.
    Integral terms are exact BIGINTs, the others DOUBLEs; ``-0.0`` is a term of
    its own (``neg_zero``), as the index's order keeps it apart."""
    keep = tuple(c for c in keep if c in docs.columns)
    num = F.filter("fields", lambda x: x["type"].isin(*NUMERIC) & x["error"].isNull())
    rows = docs.select(*keep, F.explode(num).alias("x")).select(
        F.col("x.name").alias("field"), F.col("x.type").alias("type"), whole(F.col("x")).alias("whole"),
        real(F.col("x")).alias("real"), *keep)
    rows = rows.withColumn("neg_zero", F.coalesce(negative_zero(F.col("real")), F.lit(False)))
    return rows.groupBy("field", "type", "whole", "real", "neg_zero", *keep).agg(F.count(F.lit(1)).alias("tf"))


def numeric_terms(docs: DataFrame, by_shard: bool = False) -> DataFrame:
    """Exact numeric terms ``(field, type, whole, real, neg_zero, df, ttf)``.

    Terms are grouped as one string (field, type, canonical text of the value),
    which is exact for every number type; it is decoded once per term.  Each
    document emits its distinct terms once and all its terms, so a value held
    by a third of all documents costs no hot reducer and a document with many
    fields no pairwise comparison."""
    from shardload.operators.fields import distinct_key, key_part, key_value, value_string

    keep = ["shard_id"] if by_shard else []
    num = F.filter("fields", lambda x: x["type"].isin(*NUMERIC) & x["error"].isNull())
    keys = F.transform(num, lambda x: distinct_key(x["name"], x["type"], value_string(x)))
    rows = docs.select(*keep, F.explode(F.array(keys)).alias("k")).select(*keep, F.explode(_in_row_counts(F.col("k"))).alias("r"))
    sums = rows.groupBy(F.col("r.key").alias("key"), *keep).agg(F.sum("r.df").alias("df"), F.sum("r.ttf").alias("ttf"))
    typ, text = key_part(F.col("key"), 1), key_value(F.col("key"))
    value = (F.when(typ == "float", text.try_cast("float").cast("double"))
             .when(typ == "double", text.try_cast("double")))
    return sums.select(key_part(F.col("key"), 0).alias("field"), typ.alias("type"),
                       F.when(~typ.isin("float", "double"), text.try_cast("bigint")).alias("whole"),
                       value.alias("real"), (text == "-0.0").alias("neg_zero"), *keep, "df", "ttf")
