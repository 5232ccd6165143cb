"""SentencePiece encoding and decoding by a table of prefixes.

A merge-type vocabulary gives every prefix of a text one encoding, so it has one last token.  An automaton over
all pieces finds the pieces that end at each place; the one whose pair with the last token of the prefix before it is
compatible, that is, encodes to just these two tokens, is the last token of the prefix.  The ids are read off the table from the end.

The table costs time linear in the text, however long it is.  No piece holds a blank mark behind another letter, so no token
crosses from a word to the mark of the next: words are encoded one by one and short ones are remembered.
"""

from __future__ import annotations

import importlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # stands for a blank
LETTERS = 1 << 24  # numbers from here on are letters without a piece
NOTHING, PAIR = 1 << 26, 1 << 27
NEVER = float("-inf")


@dataclass(frozen=True)
class Pieces:
    """A merge-type SentencePiece model, by a path that every executor can open.

    The bounds hold memory down and change no result: `remembered` words of at most `word` letters and `pairs` pairs of
    tokens are kept; beyond them they are worked out again.
    """

    path: str = MODEL
    remembered: int = 300_000
    word: int = 48
    pairs: int = 500_000

    def open(self) -> PieceTable:
        """The table of this worker, built once for all its tasks."""
        return _opened(self)


class PieceTable:
    def __init__(self, how: Pieces) -> None:
        self.model = importlib.import_module("sentencepiece").SentencePieceProcessor(model_file=how.path)
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        byte = {}
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_unused(i):
                raise ValueError("models with unused pieces cut tokens again, which the table does not do")
            if self.model.is_byte(i):
                byte[int(piece[1:-1], 16)] = i
            elif not (self.model.is_control(i) or self.model.is_unknown(i)):
                self.ids[piece], self.score[piece] = i, self.model.get_score(i)
        self.byte = [byte.get(b, self.model.unk_id()) for b in range(256)] if byte else None
        self.automaton = importlib.import_module("ahocorasick").Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        inner = re.compile(f"[^{MARK}]{MARK}")
        self.words = re.compile(".+" if any(map(inner.search, self.ids)) else f"{MARK}+[^{MARK}]*|[^{MARK}]+", re.S).findall
        self.known: dict[str, tuple[int, ...]] = {}
        self.fit: dict[int, bool] = {}  # by the numbers of both tokens
        self.how = how

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text by its definition: the best pair is merged, the leftmost of equals, until none is left."""
        score, parts = self.score.get, list(text)
        pairs = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while pairs and (best := max(pairs)) != NEVER:
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = score(parts[at - 1] + parts[at], NEVER)
            if at < len(pairs):
                pairs[at] = score(parts[at] + parts[at + 1], NEVER)
        return parts

    def number(self, token: str) -> int:
        """A token's id; letters without a piece are tokens too, numbered beyond all ids."""
        found = self.ids.get(token)
        return LETTERS + ord(token) if found is None else found

    def compatible(self, before: str, token: str) -> bool:
        """Whether both stay as they are next to each other; with nothing before, whether the token encodes to itself."""
        fits = self.merged(before + token) == ([before, token] if before else [token])
        if len(self.fit) >= self.how.pairs:
            self.fit.clear()
        self.fit[(self.number(before) if before else NOTHING) * PAIR + self.number(token)] = fits
        return fits

    def last_tokens(self, text: str) -> tuple[list[int], list[int]]:
        """For every prefix of `text`, the number of its last token and how many letters that has."""
        tokens: list[int] = []
        sizes: list[int] = []
        fit, done = self.fit.get, 0

        def letters(end: int) -> int:
            """Places where no piece fits end with a letter that has none."""
            for letter in text[done:end]:
                if letter in self.ids:
                    raise ValueError("no token ends here: the model is not of the merge type")
                tokens.append(LETTERS + ord(letter))
                sizes.append(1)
            return end

        for end, (size, token) in self.automaton.iter(text):  # of one end, the longest comes first
            if done > end:
                continue
            if done < end:
                done = letters(end)
            start = end + 1 - size
            fits = fit((tokens[start - 1] if start else NOTHING) * PAIR + token)
            if fits is None:
                fits = self.compatible(text[start - sizes[start - 1] : start] if start else "", text[start : end + 1])
            if fits:
                tokens.append(token)
                sizes.append(size)
                done += 1
        letters(len(text))
        return tokens, sizes

    def encode_word(self, word: str) -> tuple[int, ...]:
        tokens, sizes = self.last_tokens(word)
        ids, end = [], len(word)
        while end:
            token = tokens[end - 1]
            if token < LETTERS:
                ids.append(token)
            elif self.byte:
                ids += [self.byte[b] for b in reversed(word[end - 1].encode())]
            else:
                ids.append(self.model.unk_id())
            end -= sizes[end - 1]
        ids.reverse()
        return tuple(ids)

    def ids_of(self, text: str) -> list[int]:
        known, out = self.known, []
        for word in self.words(self.model.normalize(text)):
            ids = known.get(word)
            if ids is None:
                ids = self.encode_word(word)
                if len(word) <= self.how.word:
                    if len(known) >= self.how.remembered:
                        known.clear()
                    known[word] = ids
            out.append(ids)
        return list(chain.from_iterable(out))


@lru_cache(maxsize=1)
def _opened(how: Pieces) -> PieceTable:
    return PieceTable(how)


def _pages(rows: Iterator[tuple], schema: pa.Schema, texts: int = 500) -> Iterator[pa.RecordBatch]:
    page: list[tuple] = []
    for row in rows:
        page.append(row)
        if len(page) == texts:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*page), schema)], schema=schema)
            page = []
    if page:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*page), schema)], schema=schema)


def encode(docs: DataFrame, how: Pieces = Pieces()) -> DataFrame:
    """doc_id, ids and decoded, one row per row of `docs`: the ids of the whole text, and what they decode to.

    A null text is empty; empty texts have no ids.  Ids of rows may be null or repeat, each row is encoded by itself and other
    columns take no part.  A very long text costs time and memory in proportion to it.  No rows give none.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = how.open()

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = table.ids_of(text.as_py())
                    yield doc, ids, table.model.decode(ids)

        yield from _pages(rows(), schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def decode(tokens: DataFrame, how: Pieces = Pieces()) -> DataFrame:
    """doc_id and text of rows of doc_id and ids, as `encode` gives them; null ids decode to the empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = how.open().model
        rows = ((doc, model.decode(ids.as_py() or [])) for batch in batches for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1)))
        yield from _pages(rows, schema)

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def report(docs: DataFrame, how: Pieces = Pieces()) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""
    line = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encode(docs, how).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(line, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
