"""License scan: an Aho-Corasick automaton finds notice phrases, names and identifier tags, and a shunting-yard parser
evaluates the and/or/with expressions that follow a tag.

A text is reduced to its words joined by single blanks; every pattern is matched on whole words of that form, in one
pass whatever the number of patterns. Labels: the base phrases' own, those of further phrases, and those that a tag's
expression names. ``score`` is 1 when a tag's expression is well formed, else 0.9 for a base phrase, 0.6 for a further
phrase, 0.3 for a tag without a readable expression, 0 for nothing.

Defined results: a null or empty text has no words, no places, null first and last word, empty labels and score 0;
repeated rows give repeated results; any id, null as well, is passed on; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm import text as T
from vaultline.llm.common import documents, map_arrow

#: The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further notice phrases with labels of the method's own.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "creative commons attribution": "cc-by",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "permission is hereby granted free of charge": "mit",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAGS = ("spdx license identifier", "license expression")
TAG_TEXT = re.compile(rb"(?i)(?:spdx-license-identifier|license-expression)[\x20\x09]*:[\x20\x09]*([^\r\n]*)")
#: How identifiers of an expression begin, and their labels; the longest prefix decides.
FAMILIES = {
    "agpl": "agpl", "lgpl": "lgpl", "gpl": "gpl", "apache": "apache", "mit": "mit", "bsd": "bsd", "isc": "isc", "mpl": "mpl",
    "epl": "epl", "cc-by-nc": "cc-by-nc", "cc-by-sa": "cc-by-sa", "cc-by-nd": "cc-by-nd", "cc-by": "cc-by", "cc0": "public-domain",
}
BINDING = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"\s*(\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*)")

SCHEMA = (
    "doc_id {id}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, expression string"
)
_WORDS = bytes(b if T.LETTERS[b] else 32 for b in T.LOWER.tolist())


def parse(expression: str) -> list[str] | None:
    """An expression in postfix order, by two stacks; None if it isn't well formed. ``with`` binds closer than
    ``and``, that closer than ``or``; equal operators bind to the left. Reading stops before the first thing that
    cannot belong to an expression."""
    out: list[str] = []
    waiting: list[str] = []
    at, operand = 0, True
    while m := TOKEN.match(expression, at):
        token, word = m[1], m[1].lower()
        if operand:
            if token == "(":
                waiting.append(token)
            elif token == ")" or word in BINDING:
                return None
            else:
                out.append(token.rstrip("."))
                operand = False
        elif word in BINDING:
            while waiting and waiting[-1] != "(" and BINDING[waiting[-1]] >= BINDING[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand = True
        elif token == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        else:
            break
        at = m.end()
    if operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def family(identifier: str) -> str:
    name = identifier.lower()
    return next((FAMILIES[p] for p in sorted(FAMILIES, key=len, reverse=True) if name.startswith(p)), name)


def evaluate(postfix: list[str]) -> tuple[frozenset[str], str]:
    """The labels that an expression names, and the expression written out with brackets. A ``with`` keeps the
    label of its licence alone."""
    stack: list[tuple[frozenset[str], str]] = []
    for token in postfix:
        if token in BINDING:
            right, left = stack.pop(), stack.pop()
            stack.append((left[0] if token == "with" else left[0] | right[0], f"({left[1]} {token} {right[1]})"))
        else:
            stack.append((frozenset([family(token)]), token))
    return stack[0]


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in dict.fromkeys([*BASE, *NOTICES, *TAGS]):
        found.add_word(f" {phrase} ", (phrase, len(phrase) + 2))
    found.make_automaton()
    return found


def scan(raw: bytes, machine: ahocorasick.Automaton) -> tuple:
    words = raw.translate(_WORDS).split()
    normal = b" " + b" ".join(words) + b" "
    base, labels, expressions, score = [], set(), [], 0.0
    for end, (phrase, length) in machine.iter(normal.decode("latin-1")):
        if phrase in BASE:
            base.append((end + 1 - length, BASE[phrase]))
            labels.add(BASE[phrase])
            score = max(score, 0.9)
        if phrase in NOTICES:
            labels.add(NOTICES[phrase])
            score = max(score, 0.6)
        if phrase in TAGS:
            score = max(score, 0.3)
    if score:
        for m in TAG_TEXT.finditer(raw):
            postfix = parse(m[1].decode("utf-8", "replace"))
            if postfix:
                named, text = evaluate(postfix)
                labels |= named
                expressions.append(text)
                score = 1.0
    places = [p for p, _ in base]  # of the blanks before the phrases
    blanks = np.cumsum([0, *map(len, words)]) + np.arange(len(words) + 1) if places else np.zeros(0, np.int64)
    first, last = (int(np.searchsorted(blanks, p)) for p in (min(places), max(places))) if places else (None, None)
    return (
        len(words), len(base), first, last,
        ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), score, "; ".join(expressions),
    )


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document, without a shuffle."""
    docs = documents(docs)
    schema = SCHEMA.format(id=docs.schema["doc_id"].dataType.simpleString())
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [None, *[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton()
        for batch in batches:
            for chunk in T.chunks(batch.column("text")):
                data, at = chunk.data.tobytes(), chunk.offsets.tolist()
                rows = [scan(data[a:b], machine) for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(chunk.first, chunk.n)]
                    + [pa.array(list(c), kinds[i]) for i, c in enumerate(zip(*rows), 1)], names
                )

    return map_arrow(docs, run, schema)
