"""Licence scans: one Aho-Corasick pass finds notice phrases and identifier tags, and a shunting-yard
parser evaluates the licence expressions that stand behind tags."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Sequence

import ahocorasick
from pyspark.sql import DataFrame, SparkSession

from stockyard.llm.texts import map_texts

# Phrases, as lower-case words, and the label each stands for.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = {
    "permission is hereby granted free of charge": "mit",
    "the software is provided as is without warranty of any kind": "as-is",
    "licensed under the apache license version": "apache",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "boost",
    "free and unencumbered software released into the public domain": "unlicense",
    "creative commons attribution": "cc-by",
    "licensed under cc by": "cc-by",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by nd": "cc-by-nd",
    "all rights reserved": "all-rights-reserved",
}
# Licences without share-alike, non-commercial or proprietary terms.
PERMISSIVE = ("mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "0bsd", "zlib", "bsl-1.0", "unlicense",
              "cc0-1.0", "cc-by-4.0", "cc-by-3.0", "python-2.0", "postgresql")
TAG = "spdx license identifier"

_TAG_LINE = re.compile(rb"spdx-license-identifier\s*:[ \t]*([^\r\n]*)", re.I)
_CLOSER = re.compile(r"\s*(\*/|-->|\*\)|#\}|%>|\?>|\"\"\"|\'\'\')")
_PIECE = re.compile(r"\s*(?:([()]|[A-Za-z0-9.+:\-]+)|$)")
_BINDS = {"or": 1, "and": 2, "with": 3}
_LOWER_AND_BLANK = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                         for b in range(256))


def parse_expression(text: str) -> list[str] | None:
    """Reverse Polish form of a licence expression by the shunting-yard method; None if malformed.

    ``with`` binds tighter than ``and``, ``and`` tighter than ``or``; all bind to the left.  The closing mark of a
    comment ends the expression; any other character or piece that cannot continue it makes it malformed, since a
    licence that is not understood must not be skipped.
    """
    closer = _CLOSER.search(text)
    text = (text[:closer.start()] if closer else text).strip()
    out: list[str] = []
    waiting: list[str] = []
    operand_next = True
    at = 0
    while at < len(text):
        found = _PIECE.match(text, at)
        if not found:
            return None
        at, piece, low = found.end(), found[1], found[1].lower()
        if operand_next:
            if piece == "(":
                waiting.append(piece)
            elif piece == ")" or low in _BINDS:
                return None
            else:
                out.append(low)
                operand_next = False
        elif piece == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif low in _BINDS:
            while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= _BINDS[low]:
                out.append(waiting.pop())
            waiting.append(low)
            operand_next = True
        else:
            return None
    if operand_next:
        return None
    while waiting:
        if waiting[-1] == "(":
            return None
        out.append(waiting.pop())
    return out


def evaluate(expression: str, allowed: frozenset[str]) -> tuple[bool, list[str]] | None:
    """Whether the expression can be met with ``allowed`` licences, and the licences it names.

    ``or`` needs one side, ``and`` both; an exception after ``with`` only adds rights, so it leaves
    the answer of its licence.  None for a malformed expression.
    """
    rpn = parse_expression(expression)
    if rpn is None:
        return None
    names: list[str] = []
    stack: list[tuple[bool, str]] = []
    for piece in rpn:
        if piece not in _BINDS:
            stack.append((piece.rstrip("+") in allowed, piece))
            continue
        (right, right_name), (left, left_name) = stack.pop(), stack.pop()
        if piece == "with":
            if not left_name or not right_name:
                return None
            stack.append((left, f"{left_name} with {right_name}"))
            continue
        names += [n for n in (left_name, right_name) if n]
        stack.append((left and right if piece == "and" else left or right, ""))
    answer, name = stack.pop()
    return answer, names + [name] * bool(name)


def _automaton(base: dict[str, str], notices: dict[str, str]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for phrase in {*base, *notices, TAG}:
        machine.add_word(f" {phrase} ", (len(phrase) + 2, base.get(phrase), notices.get(phrase), phrase == TAG))
    machine.make_automaton()
    return machine


def scan(docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",), base: dict[str, str] = BASE,
         notices: dict[str, str] = NOTICES, permissive: Sequence[str] = PERMISSIVE) -> DataFrame:
    """Licence evidence of every whole text, one row per row of ``docs``.

    Adds ``n_words``, ``n_base`` (places of base phrases, overlapping ones included), ``first_word``
    and ``last_word`` (their smallest and largest start, else null), ``base_labels``, ``labels``
    (base, notices and tags; distinct, sorted, comma-joined), ``expressions`` (as written, one per
    line), ``permissive`` (every tag can be met with the permissive licences; false if a well-formed one cannot, null
    without a well-formed tag or beside a malformed one)
    and ``score``: 0 without evidence, 1 with a well-formed tag, 0.6 for one label of phrases, 0.2
    more for each further one up to 0.95.

    A null text counts as empty: no words, no labels, score 0.  Null ids, repeated rows and any
    further columns pass through untouched; an empty table gives an empty result.
    """
    allowed = frozenset(p.lower() for p in permissive)
    machines: list[ahocorasick.Automaton] = []  # built once per task, not shipped

    def one(raw: bytes | None, machine: ahocorasick.Automaton) -> tuple:
        words = (raw or b"").translate(_LOWER_AND_BLANK).split()
        flat = (b" " + b" ".join(words) + b" ").decode("utf-8", "surrogatepass")
        starts, base_labels, labels, tagged = [], set(), set(), False
        for end, (length, of_base, of_notice, is_tag) in machine.iter(flat):
            if of_base:
                starts.append(end - length + 1)
                base_labels.add(of_base)
            labels.update(x for x in (of_base, of_notice) if x)
            tagged |= is_tag
        verdicts, written, malformed = [], [], False
        phrases = len(labels)
        for line in _TAG_LINE.findall(raw) if tagged else ():
            expression = line.decode("utf-8", "replace").strip()
            found = evaluate(expression, allowed)
            malformed |= found is None
            if found:
                verdicts.append(found[0])
                written.append(expression)
                labels.update(f"spdx:{n}" for n in found[1])
        blanks = [i for i, c in enumerate(flat) if c == " "] if starts else []
        places = sorted(bisect_left(blanks, s) for s in starts)
        score = 1.0 if verdicts else min(0.95, 0.4 + 0.2 * phrases) if phrases else 0.0
        return (len(words), len(places), places[0] if places else None, places[-1] if places else None,
                ",".join(sorted(base_labels)), ",".join(sorted(labels)), "\n".join(written),
                False if not all(verdicts) else True if verdicts and not malformed else None, score)

    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "expressions", "permissive", "score")

    def batch(texts: list[bytes | None]) -> dict[str, Sequence]:
        if not machines:
            machines.append(_automaton(base, notices))
        rows = [one(t, machines[0]) for t in texts]
        return dict(zip(names, zip(*rows))) if rows else {n: [] for n in names}

    return map_texts(docs, text, carry, "n_words long, n_base long, first_word long, last_word long, base_labels string, "
                     "labels string, expressions string, permissive boolean, score double", batch)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
