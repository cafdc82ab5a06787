"""License scans by template-markup matching.

A license text is a template: mandatory words, ``<<optional>> ... <<end>>``
regions that may be missing, and ``<<any N>>`` regions that at most N other
words replace. Each template compiles to a token automaton; a place of a text
matches when the automaton accepts there, that is when all mandatory words
stand in their order exactly, whatever the replaceable regions hold. Fixed
phrases are templates without regions.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import python_ready, table, text_or_empty

# Phrases and the labels they give.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Templates of public licenses and of their usual notices, by the labels they give; any of several gives it.
TEMPLATES = {
    "apache-2.0-notice": "licensed under the apache license version 2 0 <<optional>>the license you may not use this file except in compliance with the license<<end>>",
    "mit-notice": "<<optional>>this <<any 4>> is<<end>> <<optional>>released<<end>> <<optional>>licensed<<end>> under the <<optional>>terms of the<<end>> mit license",
    "gpl-notice": "under the terms of the gnu general public license <<optional>>as published by the free software foundation<<end>> <<optional>>either<<end>> <<optional>>version <<any 1>><<end>> <<optional>>or at your option any later version<<end>>",
    "gpl-version-3": ("gnu general public license v3 <<optional>>version 3<<end>>", "gnu general public license version 3"),
    "cc-by-4.0-notice": "licensed under <<optional>>a<<end>> <<optional>>the<<end>> <<optional>>creative commons attribution<<end>> cc by <<any 2>> <<optional>>international<<end>> <<optional>>license<<end>>",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice <<optional>>including the next paragraph<<end>> shall be included in all copies or substantial portions of the software",
    "isc-text": "permission to use copy modify and <<optional>>or<<end>> distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met <<any 1>> redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer <<any 1>> redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "zlib-text": "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely",
    "spdx-tag": "spdx license identifier <<any 4>>",
}
#: Bytes of words as they are, letters in lower case, everything else a space
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


class TemplateAutomaton:
    """States are places in the template; a word leads from each to the next, and regions let it slip to their end."""

    def __init__(self, markup: str):
        self.word: list[bytes | None] = []
        self.slips: list[list[int]] = []
        self.wild: list[int] = []  # where any word may lead
        opened: list[int] = []

        def state() -> int:
            self.word.append(None)
            self.slips.append([])
            self.wild.append(-1)
            return len(self.word) - 1

        at = state()
        self.runs: list[tuple[list[str], int]] = [([], 0)]  # mandatory words that stand together, and the most words before them
        for part in re.findall(r"<<optional>>|<<end>>|<<any \d+>>|[^\s<]+", markup):
            if part.startswith("<<"):
                self.runs.append(([], 0))
            elif not opened:
                own, before = self.runs[-1]
                self.runs[-1] = ([*own, part], before if own else at)  # a state for each word before, whatever region it is in
            if part == "<<optional>>":
                opened.append(at)
            elif part == "<<end>>":
                self.slips[opened.pop()].append(at)
            elif part.startswith("<<any"):
                steps = []
                for _ in range(int(part[5:-2])):
                    steps.append(at)
                    self.wild[at] = state()
                    at += 1
                for s in steps:
                    self.slips[s].append(at)
            else:
                self.word[at] = part.encode()
                at = state()
        self.end = at
        starts = self.closed({0})
        self.first = None if any(self.wild[s] >= 0 for s in starts) else {self.word[s] for s in starts}

    def longest_run(self) -> tuple[bytes, int]:
        """The longest mandatory run, with spaces around it, without which nothing matches, and the most words of a match before it."""
        words, before = max(self.runs, key=lambda r: len(r[0]))
        if not words:
            raise ValueError("a template needs mandatory words")
        return f" {' '.join(words)} ".encode(), before

    def may_start(self, word: bytes) -> bool:
        return self.first is None or word in self.first

    def closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.slips[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def match(self, words: list[bytes], start: int) -> int:
        """The end of the longest match that starts there, or -1."""
        now, best = self.closed({0}), -1
        for k in range(start, len(words) + 1):
            if self.end in now:
                best = k
            if not now or k == len(words):
                break
            now = self.closed({s + 1 for s in now if self.word[s] == words[k]} | {self.wild[s] for s in now if self.wild[s] >= 0})
        return best


class Scanner:
    def __init__(self, templates: dict[str, str | tuple[str, ...]] = TEMPLATES, phrases: dict[str, str] = PHRASES):
        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases.items()]
        self.templates = []
        for label, markup in ((k, m) for k, own in templates.items() for m in ([own] if isinstance(own, str) else own)):
            a = TemplateAutomaton(markup)
            self.templates.append((label, a, *a.longest_run()))

    def scan(self, text: str) -> tuple:
        """The values of SCHEMA."""
        words = text.encode("utf-8", "surrogatepass").translate(TO_WORDS).split()
        line = b" " + b" ".join(words) + b" "
        n, first, last, base = 0, None, None, set()
        for phrase, label in self.phrases:
            for k in places(line, phrase):
                n, base = n + 1, base | {label}
                first, last = k if first is None else min(first, k), k if last is None else max(last, k)
        found, matched = set(), 0
        for label, automaton, run, reach in self.templates:
            done = -1  # places up to this one have been tried
            for k in places(line, run):
                for s in range(max(done + 1, k - reach), k + 1):
                    if automaton.may_start(words[s]) and (e := automaton.match(words, s)) > s:
                        found.add(label)
                        matched = max(matched, e - s)
                done = k
        score = 0.0 if not (base or found) else (0.5 if not found else 0.75) + 0.25 * min(1.0, matched / max(1, len(words)))
        return len(words), n, first, last, ",".join(sorted(base)), ",".join(sorted(base | found)), score


def places(line: bytes, run: bytes):
    """Where a run of words with spaces around it begins in a line of words, counted from the last place on."""
    at, counted, k = line.find(run), 0, -1
    while at >= 0:
        k += line.count(b" ", counted, at + 1)
        counted = at + 1
        yield k
        at = line.find(run, at + 1)


def scan_licenses(docs: DataFrame, templates: dict[str, str | tuple[str, ...]] = TEMPLATES, phrases: dict[str, str] = PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_words, n_base, first_word, last_word, base_labels, labels and score for every row of docs.

    Null texts count as empty: no words, no labels, score 0. Places count
    words from 0. score is 0 without a label, 0.5 to 0.75 with phrases alone
    and 0.75 to 1 with a template, by the share of the text that it covers.
    Repeated rows get the same, an empty table gives an empty one. One pass
    without a shuffle, in time proportional to a text's length; other columns
    aren't read.
    """
    python_ready(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        scanner = Scanner(templates, phrases)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        for batch in batches:
            rows = list(map(scanner.scan, batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(types))], names=[id_col, *names])

    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(run, f"`{id_col}` {kind}, {SCHEMA}")


def op9(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
