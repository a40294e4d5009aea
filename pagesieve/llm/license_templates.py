"""License scanning with template markup compiled to token automata.

A template is a notice written in words, with markup: ``[ ... ]`` encloses words
that may be left out, ``{n}`` stands for up to ``n`` replaceable words (a name,
a year, a version). Everything else is mandatory and must match word for word.
Markup may be nested. A template is compiled to a nondeterministic automaton over
words without empty moves; a place of the text is accepted if the automaton gets
from its start to an end there. Automata are run only at places where a text has
one of the words a template can start with, and only over texts that hold the
template's anchor, its longest run of mandatory words.

Besides, short phrases are looked up as they stand ("base" labels).

Words are runs of ASCII letters, digits and non-ASCII characters after A-Z was
lower-cased. Cases: null text has no words. A phrase counts at every place,
overlapping ones too. Repeated rows get equal rows. An empty table gives no rows.
A text without any label has an empty string and score 0; a label by phrase only
has score 0.5; one accepted by a template 1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256))

PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_GRANTS = ("licensed", "released", "distributed", "available", "provided", "published")
_GPL = "gnu general public license"
_MODIFY = "redistribute it and or modify it under the terms of the"
_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met [1 | a] redistributions of source code must retain the above copyright notice this "
    "list of conditions and the following disclaimer [2 | b] redistributions in binary form must reproduce the above "
    "copyright notice this list of conditions and the following disclaimer in the documentation and or other "
    "materials provided with the distribution ",
    "[3 | c] neither the name of {12} nor the names of [its | {2}] contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission ",
    "this software is provided by {12} as is and any express or implied warranties including but not limited to the "
    "implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall "
    "{12} be liable for any direct indirect incidental special exemplary or consequential damages including but not "
    "limited to procurement of substitute goods or services loss of use data or profits or business interruption "
    "however caused and on any theory of liability whether in contract strict liability or tort including negligence "
    "or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage")

# Notices in a line, notices and licence texts with their whole wording; the label is what a full match adds.
TEMPLATES = (
    ("mit", "[this {6}] [is] [released | licensed | distributed] under the [terms of the] mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction including "
            "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
            "of the software and to permit persons to whom the software is furnished to do so subject to the "
            "following conditions the above copyright notice and this permission notice [including the next "
            "paragraph] shall be included in all copies or substantial portions of the software the software is "
            "provided as is without warranty of any kind express or implied including but not limited to the "
            "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall "
            "{12} be liable for any claim damages or other liability whether in an action of contract tort or "
            "otherwise arising from out of or in connection with the software or the use or other dealings in the "
            "software"),
    ("apache", "licensed under the apache license version {2} [the license]"),
    ("apache-2.0", "[licensed under the] apache license version 2 [0]"),
    *((f"gpl-{n}.0", t) for n in (3, 2) for t in (
        *(f"{g} under the [terms of the] {_GPL} [as published by {{6}}] [either] version {n} [or any later version]"
          for g in _GRANTS),
        f"{_MODIFY} {_GPL} as published by the free software foundation [either] version {n} [of the license] "
        "[or at your option any later version]",
        f"{_MODIFY} {_GPL} version {n} as published by the free software foundation")),
    ("cc-by-nc", "licensed under [a] [creative commons | cc] by nc [{1} {1}] [license]"),
    ("cc-by-sa", "licensed under [a] [creative commons | cc] by sa [{1} {1}] [license]"),
    ("bsd", _BSD[0] + f"[{_BSD[1]}]" + _BSD[2]),
    ("bsd-2-clause", _BSD[0] + _BSD[2]),
    ("bsd-3-clause", "".join(_BSD)),
)


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_TABLE).split() if text else []


@dataclass
class Part:
    """A sequence of parts ("seq"), a choice with or without nothing ("opt"), a word, or a gap of words."""

    kind: str
    items: list
    word: bytes = b""
    most: int = 0


def parse(template: str) -> Part:
    """Template text to a tree. ``[a | b]`` is an optional choice."""
    tokens = re.findall(r"\{\d+\}|[\[\]|]|[^\s\[\]|{}]+", template)
    stack: list[list[Part]] = [[Part("seq", [])]]
    for t in tokens:
        if t == "[":
            stack.append([Part("seq", [])])
        elif t == "|":
            stack[-1].append(Part("seq", []))
        elif t == "]":
            if len(stack) == 1:
                raise ValueError(f"closing mark without opening: {template}")
            choices = stack.pop()
            stack[-1][-1].items.append(Part("opt", choices))
        elif t[0] == "{":
            stack[-1][-1].items.append(Part("gap", [], most=int(t[1:-1])))
        else:
            stack[-1][-1].items.extend(Part("word", [], word=w) for w in words(t))
    if len(stack) != 1 or len(stack[0]) != 1:
        raise ValueError(f"marks do not match: {template}")
    return stack[0][0]


class Automaton:
    """States are numbers; ``moves[state]`` maps a word, or None for any word, to states."""

    def __init__(self, template: str):
        self.moves: list[dict[bytes | None, set[int]]] = []
        self._empty: list[set[int]] = []
        tree = parse(template)
        self.start = self._state()
        self.end = self._add(tree, self.start)
        self._reach = [self._closure(s) for s in range(len(self.moves))]
        if self.end in self._reach[self.start]:
            raise ValueError(f"no mandatory word: {template}")
        self.first = {w for s in self._reach[self.start] for w in self.moves[s]}
        runs, run = [], []
        for part in [*tree.items, Part("gap", [])]:
            if part.kind == "word":
                run.append(part.word)
            else:
                runs, run = [*runs, run], []
        self.anchor = b" " + b" ".join(max(runs, key=len)) + b" "

    def _state(self) -> int:
        self.moves.append({})
        self._empty.append(set())
        return len(self.moves) - 1

    def _add(self, part: Part, at: int) -> int:
        if part.kind == "word":
            to = self._state()
            self.moves[at].setdefault(part.word, set()).add(to)
            return to
        if part.kind == "seq":
            for item in part.items:
                at = self._add(item, at)
            return at
        out = self._state()
        self._empty[at].add(out)
        if part.kind == "opt":
            for choice in part.items:
                self._empty[self._add(choice, at)].add(out)
            return out
        for _ in range(part.most):
            to = self._state()
            self.moves[at].setdefault(None, set()).add(to)
            self._empty[to].add(out)
            at = to
        return out

    def _closure(self, state: int) -> frozenset[int]:
        seen, todo = {state}, [state]
        while todo:
            for s in self._empty[todo.pop()] - seen:
                seen.add(s)
                todo.append(s)
        return frozenset(seen)

    def accepts_at(self, text: Sequence[bytes], place: int) -> bool:
        """Whether a match starts at word ``place``."""
        states = self._reach[self.start]
        for word in text[place:place + len(self.moves) * 2]:
            states = {r for s in states for key in (word, None) for to in self.moves[s].get(key, ())
                      for r in self._reach[to]}
            if self.end in states:
                return True
            if not states:
                return False
        return False

    def find(self, text: Sequence[bytes]) -> bool:
        return any((None in self.first or w in self.first) and self.accepts_at(text, i) for i, w in enumerate(text))


class Scanner:
    """Phrases and automata, ready for texts; one per task."""

    def __init__(self, phrases: Mapping[str, str] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES):
        self._phrases = [(b" " + b" ".join(words(p)) + b" ", label) for p, label in phrases.items()]
        self._automata = [(label, Automaton(t)) for label, t in templates]

    def scan(self, text: str | None) -> tuple:
        """``n_words, n_base, first_word, last_word, base_labels, labels, score``."""
        found = words(text)
        line = b" " + b" ".join(found) + b" "
        starts, base = [], set()
        for phrase, label in self._phrases:
            at = line.find(phrase)
            while at >= 0:
                starts.append(line.count(b" ", 0, at))
                base.add(label)
                at = line.find(phrase, at + 1)
        accepted = {label for label, a in self._automata if a.anchor in line and a.find(found)}
        return (len(found), len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(base | accepted)),
                1.0 if accepted else 0.5 if base else 0.0)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         phrases: Mapping[str, str] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per row of ``docs``."""
    id_type = docs.schema[id_col].dataType.simpleString()
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        for batch in batches:
            rows = [scanner.scan(t) for t in batch.column(1).to_pylist()]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                names=[id_col, *names])

    return docs.select(id_col, text_col).mapInArrow(
        scanned, f"`{id_col}` {id_type}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                 "base_labels string, labels string, score double")
