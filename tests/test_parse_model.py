"""Randomized comparison of the Spark parser with a plain-Python model of
the line semantics (Java split rules, the re-join of cells after the id, the
part rules and Java's number parsing)."""

import random
import re

import numpy as np
import pytest

from conftest import lines_df
from shardload.operators.fields import parse_docs
from shardload.sources.lines import keyed_lines

INT_RANGE = {"integer": 2**31, "long": 2**63, "short": 2**15}


def jsplit(s, sep):
    if s == "":
        return [""]
    while s.endswith(sep):
        s = s[: -len(sep)]
    return [] if s == "" else s.split(sep)


def model_value(raw, typ):
    if typ in INT_RANGE:
        if not re.fullmatch(r"[+-]?[0-9]+", raw):
            return None
        v = int(raw)
        return v if -INT_RANGE[typ] <= v < INT_RANGE[typ] else None
    try:
        v = float(raw.strip())
    except ValueError:
        return None
    return float(np.float32(v)) if typ == "float" else v


def model_line(line, delim, auto):
    cells = jsplit(line, delim)
    if auto:
        if len(cells) < 1:
            return None
        payload = line
    else:
        if len(cells) < 2:
            return None
        payload = ""
        for c in cells[1:]:
            if payload:
                payload += delim
            payload += c
    out = []
    for cell in jsplit(payload, delim):
        for col in jsplit(cell, ","):
            p = jsplit(col, ":")
            if len(p) == 0:
                out.append((None, None, None, "malformed"))
            elif len(p) == 1:
                out.append(("col_" + p[0], "integer", 1, None))
            elif len(p) == 2:
                out.append((p[0], "string", p[1], None))
            else:
                t = p[2].lower()
                if t in ("integer", "long", "short", "float", "double"):
                    v = model_value(p[1], t)
                    out.append((p[0], t, v, None if v is not None else "bad_" + t))
                else:
                    out.append((p[0], "string", p[1], None))
    return (None if auto else cells[0], out)


def random_line(rnd, delim):
    pieces = ["a", "b", "1", "-2", "+3", "1.5", "1e3", " 7", "40000", "99999999999", ".5", "x",
              ":", ":", ",", ",", delim, delim, "integer", "SHORT", "long", "Float", "double", "t"]
    return "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 14)))


def _spark_value(f):
    for k in ("i", "l", "s", "f", "d", "str"):
        if f[k] is not None:
            return float(f[k]) if k in ("f", "d") else f[k]
    return None


@pytest.mark.parametrize("delim,auto", [("\t", False), ("|", False), ("\t", True)])
def test_parser_matches_model(spark, delim, auto):
    rnd = random.Random(11 if auto else 5)
    lines = [random_line(rnd, delim) for _ in range(500)]
    expected = {}
    for i, l in enumerate(lines):
        m = model_line(l, delim, auto)
        if m is not None:
            expected[i] = m
    df = lines_df(spark, lines)           # _doc follows the input order here
    order = {r["_doc"]: i for i, r in enumerate(df.orderBy("_doc").collect())}
    got = {}
    for r in parse_docs(keyed_lines(df, delim=delim, auto_id=auto), delim=delim, on_error="null").collect():
        fields = [(f["name"], f["type"], _spark_value(f), f["error"]) for f in r["fields"]]
        got[order[r["_doc"]]] = (None if auto else r["_id"], fields)
    assert set(got) == set(expected), sorted(set(got) ^ set(expected))[:5]
    bad = [(lines[i], got[i], expected[i]) for i in expected if got[i] != expected[i]]
    assert not bad, bad[:3]
