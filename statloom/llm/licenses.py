"""License scans by template-markup matching.

A template is license wording with two kinds of mark-up: ``<<beginOptional>> ... <<endOptional>>``
around words that may be missing (they may be nested), and ``<<var;name=...;words=LOW-HIGH>>`` for a
replaceable region of so many arbitrary words. It is compiled into a token automaton: a state per
word, a state per word of a replaceable region, and empty moves around what may be missing. A text
is labelled when the automaton accepts a run of its words, that is when all mandatory wording is
there exactly. The longest mandatory run of a template is looked for first; texts without it can't
be accepted, so the automaton runs over few texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from statloom.llm.common import arrow_rows, col

# ---- fixed values: the phrases that always count, with their labels ----
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# ---- end of fixed values ----

#: Labels of the method, with their templates.
TEMPLATES = {
    "mit-text": """<<beginOptional>>Copyright <<beginOptional>>(c)<<endOptional>> <<var;name=holder;words=0-12>><<endOptional>>
        Permission is hereby granted, free of charge, to any person obtaining a copy of
        <<var;name=software;words=1-8>> and associated documentation files
        (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
        sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice
        <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions
        of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
        NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
        NONINFRINGEMENT. IN NO EVENT SHALL <<var;name=holder;words=1-12>> BE LIABLE FOR ANY CLAIM, DAMAGES
        OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH
        THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc-text": """Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any
        purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice
        appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND <<var;name=holder;words=1-12>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
        INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;name=holder;words=1-12>> BE
        LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF
        USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
        CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "bsd-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met:
        <<var;name=bullet;words=0-1>> Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer.
        <<var;name=bullet;words=0-1>> Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
        <<beginOptional>><<var;name=bullet;words=0-1>> All advertising materials mentioning features or use of this software
        must display the following acknowledgement: This product includes software developed by
        <<var;name=holder;words=1-20>>.<<endOptional>>
        <<beginOptional>><<var;name=bullet;words=0-1>> Neither the name of <<var;name=holder;words=1-20>> may be used to endorse
        or promote products derived from this software without specific prior written permission.<<endOptional>>
        THIS SOFTWARE IS PROVIDED BY <<var;name=holder;words=1-20>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
        NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
        EVENT SHALL <<var;name=holder;words=1-20>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
        CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA,
        OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
        LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
        ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "apache-notice": """Licensed under the Apache License, <<beginOptional>>Version 2.0<<endOptional>>
        <<beginOptional>>(the "License")<<endOptional>>""",
    "gpl-notice": """<<var;name=program;words=1-6>> is free software<<beginOptional>>:<<endOptional>> you can redistribute it
        and/or modify it under the terms of the GNU <<beginOptional>>Lesser<<endOptional>>
        <<beginOptional>>Affero<<endOptional>> General Public License as published by the Free Software Foundation""",
    "gpl-terms": """under the terms of the GNU <<beginOptional>>Lesser<<endOptional>> <<beginOptional>>Affero<<endOptional>>
        General Public License""",
    "gpl-version": """<<beginOptional>>This work is<<endOptional>> <<beginOptional>>Licensed<<endOptional>> under the GNU
        <<beginOptional>>Lesser<<endOptional>> <<beginOptional>>Affero<<endOptional>> General Public License
        <<beginOptional>>as published by the Free Software Foundation, either<<endOptional>> version
        <<var;name=version;words=1-2>>""",
    "mit-notice": """<<beginOptional>>Released<<endOptional>> <<beginOptional>>Distributed<<endOptional>>
        <<beginOptional>>Licensed<<endOptional>> under the <<beginOptional>>terms of the<<endOptional>> MIT License""",
    "cc-notice": """This work is licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>>
        <<var;name=family;words=0-6>> Attribution <<var;name=kind;words=0-5>> License""",
    "cc-by-version": """CC BY <<beginOptional>>NC<<endOptional>> <<beginOptional>>SA<<endOptional>>
        <<beginOptional>>ND<<endOptional>> 4.0""",
    "unlicense-text": """This is free and unencumbered software released into the public domain.
        Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
        as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
        In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
        interest in the software to the public domain. We make this dedication for the benefit of the public at large and to
        the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in
        perpetuity of all present and future rights to this software under copyright law.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
        <<beginOptional>>For more information, please refer to <<var;name=address;words=1-6>><<endOptional>>""",
    "mpl-notice": """This Source Code Form is subject to the terms of the Mozilla Public License""",
}

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
ANY = None


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


@dataclass
class Automaton:
    """States 0..n; state i reads ``reads[i]`` (ANY: every word) and goes to i + 1; ``skips`` are empty moves."""

    label: str
    reads: list[bytes | None] = field(default_factory=list)
    skips: dict[int, set[int]] = field(default_factory=dict)
    anchor: bytes = b""

    def closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        seen = set(states)
        while todo:
            for s in self.skips.get(todo.pop(), ()):
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return seen

    def match(self, words: list[bytes], at: int) -> int | None:
        """End of the longest run of words from ``at`` that is accepted."""
        final = len(self.reads)
        states, end = self.begin, None
        for i in range(at, len(words) + 1):
            if final in states:
                end = i
            if i == len(words):
                break
            states = self.closure({s + 1 for s in states if s < final and self.reads[s] in (ANY, words[i])})
            if not states:
                break
        return end if end is not None and end > at else None

    def spans(self, words: list[bytes]) -> list[tuple[int, int]]:
        """All places that are accepted, from the left, without overlaps."""
        found, at = [], 0
        while at < len(words):
            end = self.match(words, at) if self.anywhere or words[at] in self.firsts else None
            if end is not None:
                found.append((at, end))
                at = end
            else:
                at += 1
        return found


def compile_template(label: str, template: str) -> Automaton:
    made = Automaton(label)
    open_at: list[int] = []
    depth, run, best = 0, [], []

    def skip(a: int, b: int) -> None:
        if a != b:
            made.skips.setdefault(a, set()).add(b)

    for mark, plain in re.findall(r"<<(.*?)>>|((?:(?!<<).)+)", template, re.S):
        kind = mark.split(";")[0].strip()
        if kind == "beginOptional":
            open_at.append(len(made.reads))
            depth += 1
        elif kind == "endOptional":
            if not open_at:
                raise ValueError(f"{label}: endOptional without beginOptional")
            skip(open_at.pop(), len(made.reads))
            depth -= 1
        elif kind == "var":
            low, high = map(int, re.search(r"words=(\d+)-(\d+)", mark).groups())
            for i in range(high):
                if i >= low:
                    skip(len(made.reads), len(made.reads) + 1)
                made.reads.append(ANY)
        elif mark:
            raise ValueError(f"{label}: unknown mark-up {mark}")
        if mark:
            best, run = max(best, run, key=len), []
        else:
            found = words_of(plain.encode())
            made.reads += found
            if not depth:
                run += found
    best = max(best, run, key=len)
    if open_at or not best:
        raise ValueError(f"{label}: unclosed optional region or no mandatory words")
    made.anchor = b" " + b" ".join(best) + b" "
    made.begin = made.closure({0})
    reading = [made.reads[s] for s in made.begin if s < len(made.reads)]
    made.anywhere, made.firsts = ANY in reading, set(reading)
    return made


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict | None = None, templates: dict | None = None) -> DataFrame:
    """One row per document: word and phrase counts, places, labels, a score, and the template spans.

    ``n_base`` counts the places of the phrases, overlapping ones included; ``first_word`` and
    ``last_word`` are their smallest and largest start, NULL without a place. ``base_labels`` and
    ``labels`` (the templates' too) are distinct, sorted and comma-joined, empty without a match.
    ``spans`` lists the templates' places as (label, first word, words). ``score`` is the share of the
    words inside a place of either kind, 0 for a text without words. A NULL text counts as empty;
    repeated rows and NULL ids give a row each; other columns are left behind.
    """
    from pyspark.sql import functions as F

    phrases, templates = phrases or PHRASES, templates or TEMPLATES
    base = [(b" " + p.encode() + b" ", len(p.split()), label) for p, label in phrases.items()]
    automata = [compile_template(label, t) for label, t in templates.items()]

    def places(text: str | bytes) -> dict:
        words = words_of(text)
        line = b" " + b" ".join(words) + b" "
        covered = np.zeros(len(words), dtype=bool)
        starts, labels, own, spans = [], set(), set(), []
        for phrase, size, label in base:
            at, before, seen = line.find(phrase), 0, 0
            while at >= 0:
                before += line.count(b" ", seen, at)  # blanks before a word: its number
                seen = at
                starts.append(before)
                covered[before : before + size] = True
                labels.add(label)
                at = line.find(phrase, at + 1)
        for automaton in automata:
            if automaton.anchor in line:
                for a, b in automaton.spans(words):
                    covered[a:b] = True
                    own.add(automaton.label)
                    spans.append({"label": automaton.label, "first_word": a, "words": b - a})
        return {
            "n_words": len(words),
            "n_base": len(starts),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(labels)),
            "labels": ",".join(sorted(labels | own)),
            "score": float(covered.mean()) if len(words) else 0.0,
            "spans": spans,
        }

    def step(batch):
        rows = [places(t) for t in batch.column("text").to_pylist()]
        out = {k: [r[k] for r in rows] for k in rows[0]} if rows else {}
        return {"doc_id": batch.column("doc_id"), **out}

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<label:string,first_word:long,words:long>>"
    )
    rows = df.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    return arrow_rows(rows, schema, step, "text")
