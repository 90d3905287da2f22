"""JSON as models write it: fences, text around the object, unquoted keys, missing and trailing commas, loose quotes."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

FENCE = re.compile(r"```(?:json)?\s*(.*?)```", re.S | re.I)
TOKEN = re.compile(r'\s+|"(?:[^"\\]|\\.)*"|[{}\[\],:]|[^\s{}\[\],:"]+|"', re.S)
PAIR = re.compile(r'"(level|chapter|page)"\s*:\s*("(?:[^"\\]|\\.)*"|-?\d+)')


def unfenced(text: str) -> str:
    m = FENCE.search(text)
    return (m[1] if m else text).strip()


def first_object(text: str) -> str | None:
    """The first balanced {...}, quotes honoured; else up to the last }."""
    start = text.find("{")
    if start < 0:
        return None
    depth, quoted, skip = 0, False, False
    for k in range(start, len(text)):
        ch = text[k]
        if skip:
            skip = False
        elif quoted:
            skip, quoted = ch == "\\", ch != '"'
        elif ch == '"':
            quoted = True
        elif ch in "{}":
            depth += 1 if ch == "{" else -1
            if not depth:
                return text[start : k + 1]
    end = text.rfind("}")
    return text[start : end + 1] if end > start else None


def inner_quotes_escaped(text: str) -> str:
    """Quotes inside a string that no comma, colon or bracket follows are escaped."""
    out, quoted, k = [], False, 0
    while k < len(text):
        ch = text[k]
        if ch == "\\" and quoted:
            out.append(text[k : k + 2])
            k += 2
            continue
        if ch == '"':
            if not quoted:
                quoted = True
            elif re.match(r"\s*(?:[,:}\]]|$)", text[k + 1 :]):
                quoted = False
            else:
                ch = '\\"'
        out.append(ch)
        k += 1
    return "".join(out)


def _scalar(token: str) -> str:
    if token[0] == '"' or token in ("true", "false", "null") or re.fullmatch(r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?", token):
        return token
    return json.dumps(token, ensure_ascii=False)


def repaired(text: str) -> str:
    """Commas and colons put where an object or array needs them, keys quoted, brackets closed."""
    out: list[str] = []
    stack: list[str] = []
    want = "value"  # value, key, colon, or after (a comma or the end)
    for t in TOKEN.findall(text):
        if t.isspace():
            continue
        if t in "}]":
            while out and out[-1] in (",", ":"):
                out.append("null") if out[-1] == ":" else out.pop()
                if out and out[-1] == "null":
                    break
            if stack and {"{": "}", "[": "]"}[stack[-1]] == t:
                stack.pop()
                out.append(t)
                want = "after"
            continue
        if t == ",":
            if want == "after":
                out.append(",")
                want = "key" if stack and stack[-1] == "{" else "value"
            continue
        if t == ":":
            if want == "colon":
                out.append(":")
                want = "value"
            continue
        if want == "after":
            out.append(",")
            want = "key" if stack and stack[-1] == "{" else "value"
        if want == "colon":
            out.append(":")
            want = "value"
        if t in "{[":
            out.append(t)
            stack.append(t)
            want = "key" if t == "{" else "value"
        elif want == "key":
            out.append(t if t[0] == '"' and len(t) > 1 else json.dumps(t.strip('"'), ensure_ascii=False))
            want = "colon"
        else:
            out.append(_scalar(t) if t != '"' else '""')
            want = "after"
    while out and out[-1] in (",", ":"):
        out.pop()
    return "".join(out) + "".join({"{": "}", "[": "]"}[b] for b in reversed(stack))


def loose_entries(text: str) -> dict | None:
    """Level, chapter and page pairs of innermost objects, whatever is around them."""
    found = []
    for block in re.findall(r"\{[^{}]*\}", text):
        entry = {k: json.loads(v) for k, v in PAIR.findall(block)}
        if "chapter" in entry:
            found.append(entry)
    return {"chapters": found} if found else None


def parsed(text: str | None) -> dict | None:
    """The object that text holds: as it is, extracted, with quotes escaped, repaired, both; else its loose entries."""
    raw = unfenced(text or "")
    inner = first_object(raw) or raw
    for make in (lambda: raw, lambda: inner, lambda: inner_quotes_escaped(inner), lambda: repaired(inner), lambda: repaired(inner_quotes_escaped(inner))):
        try:
            value = json.loads(make())
        except (ValueError, RecursionError):
            continue
        if isinstance(value, dict):
            return value
    return loose_entries(raw)


def _repair(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(lambda t: None if (v := parsed(t)) is None else json.dumps(v, ensure_ascii=False))


def repair_json(text: Column) -> Column:
    """Canonical JSON of the object in a model's answer, null if there is none: an Arrow UDF, for what from_json can't read."""
    return F.pandas_udf(_repair, "string")(text)


def read_answer(text: Column, schema: str) -> Column:
    """The answer by schema, of whatever repair_json makes of it."""
    return F.from_json(repair_json(text), schema)
