"""SQL fragments (DuckDB dialect) used by the correctness oracles.

They re-state, as plain SQL over the original tables, what the Spark
pipeline computes from the encoded lines: the routing hash, Java split
rules, and the epoch conversions of the line encoders.
"""

from __future__ import annotations

M32 = "4294967296"


def _bind(expr: str, var: str, body: str) -> str:
    """Evaluate ``body`` with ``var`` bound to ``expr`` (once)."""
    return f"(list_transform([{expr}], lambda {var}: {body})[1])"


def _rotl(x: str, r: int) -> str:
    return f"((({x}) * {2 ** r}) % {M32} + ({x}) // {2 ** (32 - r)})"


def _mix_k(k: str) -> str:
    return _bind(f"(({k}) * 3432918353) % {M32}", "mk", f"({_rotl('mk', 15)} * 461845907) % {M32}")


def murmur3_signed(s: str) -> str:
    """Signed murmur3_x86_32 (seed 0) of the UTF-16 code units of VARCHAR ``s``.

    Code points equal UTF-16 units below U+10000, which holds for every id the
    line encoders produce.
    """
    unit = lambda pos: f"unicode(substr(sv, {pos}, 1))::HUGEINT"
    blocks = (f"list_transform(range(length(sv) // 2), lambda bi: "
              f"{_mix_k(f'{unit('2 * bi + 1')} + 65536 * {unit('2 * bi + 2')}')})")
    body = (f"list_reduce(list_prepend(0::HUGEINT, {blocks}), lambda acc, kk: "
            f"({_rotl('xor(acc, kk)', 13)} * 5 + 3864292196) % {M32})")
    tail = (f"CASE WHEN length(sv) % 2 = 1 THEN xor(hb, {_mix_k(unit('length(sv)'))}) ELSE hb END")
    fin = _bind(f"xor({_bind(body, 'hb', tail)}, 2 * length(sv))", "h0",
                _bind("xor(h0, h0 >> 16)", "h1",
                      _bind(f"(h1 * 2246822507) % {M32}", "h2",
                            _bind("xor(h2, h2 >> 13)", "h3",
                                  _bind(f"(h3 * 3266489909) % {M32}", "h4",
                                        _bind("xor(h4, h4 >> 16)", "h5",
                                              f"CASE WHEN h5 >= 2147483648 THEN h5 - {M32} ELSE h5 END"))))))
    return _bind(s, "sv", fin)


def shard_sql(s: str, shards: int) -> str:
    return f"CAST(((({murmur3_signed(s)}) % {shards}) + {shards}) % {shards} AS INTEGER)"


def epoch_days_sql(ts: str) -> str:
    return f"CAST(date_diff('day', DATE '1970-01-01', CAST({ts} AS DATE)) AS INTEGER)"


def epoch_seconds_sql(ts: str) -> str:
    return (f"(CAST({epoch_days_sql(ts)} AS BIGINT) * 86400 + hour({ts}) * 3600 + minute({ts}) * 60 "
            f"+ CAST(floor(second({ts})) AS BIGINT))")


def java_split_sql(s: str, sep_regex: str) -> str:
    """Java split of ``s`` on a regex-quoted separator (no lambda needed)."""
    t = f"regexp_replace({s}, '({sep_regex})+$', '')"
    return (f"(CASE WHEN {s} = '' THEN [''] WHEN {t} = '' THEN []::VARCHAR[] "
            f"ELSE regexp_split_to_array({t}, '{sep_regex}') END)")


def dstr(x: str) -> str:
    """DuckDB double → text in the same form as Java for the magnitudes the
    encoders produce (plain decimals between 1e-3 and 1e7)."""
    return f"CAST({x} AS VARCHAR)"
