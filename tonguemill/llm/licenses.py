"""License scans: short notices found with spelling errors.

A notice of n letters may differ by up to e edits.  Cut into e + 1 pieces, any such occurrence holds one piece unchanged
(the pigeonhole principle), so one pass of an automaton over all pieces finds every place worth a look; there the `regex`
library matches the notice with bounded errors and gives edits and span.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tonguemill.llm.common import letter_words, utf8

#: The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Short notices by label, in words as they are compared (lower case, single blanks).
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("epl", "made available under the terms of the eclipse public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc", "licensed under a creative commons attribution"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nd", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
    ("mit", "this project is licensed under the terms of the mit license"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies"),
    ("mit", "distributed under the mit software license"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "released under the apache 2 0 license"),
    ("bsd", "use of this source code is governed by a bsd style license"),
    ("bsd", "licensed under the bsd 3 clause license"),
    ("bsd", "licensed under the bsd 2 clause license"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse"),
    ("gpl", "this program is free software you can redistribute it and or modify it"),
    ("gpl", "licensed under the gnu general public license version 2"),
    ("lgpl", "this library is free software you can redistribute it and or modify it"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("fdl", "under the terms of the gnu free documentation license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("epl", "licensed under the eclipse public license version 2 0"),
    ("eupl", "licensed under the european union public licence"),
    ("cddl", "subject to the terms of the common development and distribution license"),
    ("boost", "distributed under the boost software license version 1 0"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("artistic", "licensed under the artistic license version 2 0"),
    ("ofl", "this font software is licensed under the sil open font license version 1 1"),
    ("psf", "licensed under the python software foundation license version 2"),
    ("postgresql", "released under the postgresql license"),
    ("odbl", "made available under the open database license"),
    ("wtfpl", "under the terms of the do what the fuck you want to public license"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced"),
)
ERROR_SHARE = 14  # one edit for so many letters; seeds are then at least seven letters long

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "notices array<struct<label:string,start_word:long,end_word:long,edits:int>>"
)


@dataclass(frozen=True)
class Scanner:
    notices: tuple[tuple[str, str], ...] = NOTICES
    error_share: int = ERROR_SHARE

    def build(self) -> Automaton:
        return Automaton(self)


class Automaton:
    """Built once per task: the pieces of all notices, and a pattern for each notice."""

    def __init__(self, scanner: Scanner) -> None:
        self.pieces = ahocorasick.Automaton()
        self.notices = []
        self.texts = [notice for _, notice in scanner.notices]
        self.letters = [Counter(notice) for notice in self.texts]
        found: dict[str, list[tuple[int, int]]] = {}
        for k, (label, notice) in enumerate(scanner.notices):
            edits = max(1, len(notice) // scanner.error_share)
            bounds = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
            for start, end in zip(bounds, bounds[1:]):
                found.setdefault(notice[start:end], []).append((k, start))
            pattern = regex.compile(rf"(?be)(?<![^ ])(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits}}}(?![^ ])")
            self.notices.append((label, len(notice), edits, pattern))
        for piece, where in found.items():
            self.pieces.add_word(piece, (len(piece), where))
        self.pieces.make_automaton()

    def search(self, text: str) -> list[tuple[str, int, int, int]]:
        """label, start, end and edits of the notices, by start.  Each place that seeds point to is verified in a window of its own."""
        seeds: dict[int, list[tuple[int, int]]] = {}
        whole: list[tuple[str, int, int, int]] = []
        for last, (length, where) in self.pieces.iter(text):
            for k, offset in where:
                seeds.setdefault(k, []).append((last + 1 - length - offset, last))
                if not offset and self._stands(k, text, last + 1 - length):
                    whole.append((self.notices[k][0], last + 1 - length, last + 1 - length + self.notices[k][1], 0))
        exact = bytearray(len(text)) if whole else b""
        for _, start, end, _ in whole:
            exact[start:end] = b"\1" * (end - start)
        out = []
        for k, mine in seeds.items():
            label, size, edits, pattern = self.notices[k]
            if whole:  # what overlaps a notice without edits has more of them, and is not the wording there
                mine = [x for x in mine if not exact[x[1]]]
            mine.sort()
            at = 0
            while at < len(mine):
                # Seeds of one place imply starts that differ by the edits between them; each place has a window of its own.
                first = last = mine[at][0]
                while at < len(mine) and mine[at][0] - first <= 2 * edits:
                    last = mine[at][0]
                    at += 1
                begin, end = max(0, first - edits - 1), last + size + 2 * edits + 2
                # An edit takes at most one letter of the notice away.
                if (self.letters[k] - Counter(text[begin:end])).total() > edits:
                    continue
                m = pattern.search(text, begin, end)
                if m and (m.end() < end or text[end : end + 1] in ("", " ")):  # a word that the window cuts off has not ended
                    a, b = m.span()
                    while a < b and text[a] == " ":
                        a += 1
                    out.append((label, a, b, sum(m.fuzzy_counts)))
        return nearest(out + whole)

    def _stands(self, k: int, text: str, start: int) -> bool:
        """Whether the notice stands at `start` without edits, as whole words."""
        end = start + self.notices[k][1]
        return text.startswith(self.texts[k], start) and (not start or text[start - 1] == " ") and text[end : end + 1] in ("", " ")


def nearest(found: list[tuple[str, int, int, int]]) -> list[tuple[str, int, int, int]]:
    """Of notices that overlap, those with the fewest edits (then the longest): a text has one wording at a place."""
    rank = lambda x: (x[3], x[1] - x[2])
    kept: list[tuple[str, int, int, int]] = []
    together: list[tuple[str, int, int, int]] = []
    reach = -1

    def settle() -> None:
        mine: list[tuple[str, int, int, int]] = []
        for one in sorted(together, key=lambda x: (*rank(x), x[1], x[0])):
            if not any(one[1] < k[2] and k[1] < one[2] and rank(k) != rank(one) for k in mine):
                mine.append(one)
        kept.extend(mine)
        together.clear()

    for one in sorted(set(found), key=lambda x: (x[1], x[2], x[0])):
        if one[1] >= reach:
            settle()
        together.append(one)
        reach = max(reach, one[2])
    settle()
    return sorted(kept, key=lambda x: (x[1], x[2], x[0]))


def word_places(text: bytes, starts: list[int]) -> list[int]:
    """How many blanks stand before each of the ascending places."""
    out, at, n = [], 0, 0
    for start in starts:
        n += text.count(b" ", at, start)
        at = start
        out.append(n)
    return out


def _byte_places(line: str, starts: list[int]) -> list[int]:
    """The places of ascending code points in the line's bytes."""
    out, at, n = [], 0, 0
    for start in starts:
        n += len(line[at:start].encode())
        at = start
        out.append(n)
    return out


def scan_text(text: bytes | None, automaton: Automaton) -> tuple:
    """One result row without its doc_id."""
    words = letter_words(text)
    joined = b" " + b" ".join(words) + b" "
    places, base = [], set()
    if b" license " in joined:
        for phrase, label in BASE.items():
            wanted = b" " + phrase.encode() + b" "
            at = joined.find(wanted)
            starts = []
            while at >= 0:
                starts.append(at)
                base.add(label)
                at = joined.find(wanted, at + 1)
            places += word_places(joined, starts)
    line = joined[1:-1].decode("utf-8", "replace")
    found = automaton.search(line) if line else []
    labels = base | {label for label, *_ in found}
    sizes = {label: 0.0 for label in labels}
    for label, start, end, edits in found:
        sizes[label] = max(sizes[label], 1 - edits / max(1, end - start))
    score = 1.0 if base else max(sizes.values(), default=0.0)
    ends = sorted({x for _, start, end, _ in found for x in (start, end)})
    place = dict(zip(ends, word_places(line[: ends[-1]].encode(), _byte_places(line, ends)))) if found else {}
    notices = [
        {"label": label, "start_word": place[start], "end_word": place[end] + 1, "edits": edits} for label, start, end, edits in found
    ]
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), min(1.0, max(0.0, score)), notices,
    )


def scan(docs: DataFrame, scanner: Scanner = Scanner()) -> DataFrame:
    """A row for every row of `docs`: the base phrases' places, the labels, and the notices with spans and edits.

    A null text is an empty one without words; ids may be null or repeat, each row is scanned by itself, and other columns take
    no part.  Notices that overlap with as many edits and letters are all kept.  A very long text is scanned whole, by work in
    proportion to its length and to the places that seeds point to.  No rows give none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = scanner.build()
        for batch in batches:
            rows = [scan_text(text, automaton) for text in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) or [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), _NOTICE]
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=_NAMES)

    return docs.select(docs.doc_id.cast("long"), utf8("text").alias("text")).mapInArrow(run, SCHEMA)


_NOTICE = pa.list_(pa.struct([("label", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("edits", pa.int32())]))
_NAMES = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"]
