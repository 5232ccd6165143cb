"""Suffix-array dedup with a run-length index: bytes covered by a long string that also starts elsewhere are found and removed.

Every 400-byte window has an anchor, the 200-byte string in it whose hash is least (the leftmost of equals).  Equal windows have
equal anchors at equal places, so windows need comparing only where their anchor repeats.  The windows of a
document that share an anchor make a context.  Contexts that occur twice are marked at once; of each other context of a repeated
anchor one example goes into the index.

The contexts of an anchor are aligned at it, and their Burrows-Wheeler transform is built column by column from the right
(positional BWT): the order of the contexts by what follows a column, kept as runs of equal letters.  A column's runs are
sorted, not its rows; lengths of matches between neighbours grow by one inside runs, and only at run ends is a
minimum over the runs between taken, from one sample per run.  These lengths are the matching statistics of all contexts:
where one reaches 400, the window that starts in this column is marked.

Contexts of different anchors share a task, about `bucket` of them.  An anchor with more than `most` contexts is not
put into one task: hashes of its windows are counted instead, which gives the same marks.

The same search runs a second time on texts written as four bytes a word, for passages of so many words that also stand elsewhere:
these may have fewer bytes than are asked for.  They are reported and nothing of them is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonguemill.llm.common import text_key, utf8
from tonguemill.session import materialize

SEGMENT = 1 << 19  # windows that are worked on at a time; places in a segment take the low 20 bits of a key
_PLACE = np.uint64((1 << 20) - 1)


@dataclass(frozen=True)
class Repeats:
    """length: bytes of a string that must not repeat; words: whether texts are read as words of four bytes each."""

    length: int = 400
    anchor: int = 200
    bucket: int = 3000
    most: int = 4096
    words: bool = False

    @property
    def reach(self) -> int:
        return self.length - self.anchor + 1

    def units(self, text: bytes | None) -> bytes:
        """What is searched of a text: its bytes, or checksums of its words between blanks."""
        if not text or not self.words:
            return text or b""
        words = text.split()
        return np.fromiter(map(crc32, words), np.uint32, len(words)).tobytes()


WORD_BYTES = 4
#: Passages of over 50 words.
PASSAGE = Repeats(length=51 * WORD_BYTES, anchor=15 * WORD_BYTES, words=True)


# --- anchors -------------------------------------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15
_LETTERS = np.random.default_rng(7).integers(0, 1 << 64, 256, np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * (out[done - 1 : done] * np.uint64(base))
        done += more
    return out


class Hasher:
    """Rolling hashes of all strings of a length, by prefix sums of a polynomial modulo 2^64."""

    def __init__(self, most: int) -> None:
        self.up, self.down = _powers(_BASE, most), _powers(pow(_BASE, -1, 1 << 64), most)

    def all(self, data: np.ndarray, length: int) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LETTERS[data] * self.up[: len(data)], out=sums[1:])
        n = len(data) - length + 1
        x = (sums[length:] - sums[:n]) * self.down[:n]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def contexts(text: bytes, how: Repeats, hasher: Hasher) -> Iterator[tuple[np.ndarray, ...]]:
    """For pieces of a text: anchor hash, first window, number of windows, and place of the anchor after the first window."""
    last = len(text) - how.length + 1
    for base in range(0, last, SEGMENT):
        n = min(SEGMENT, last - base)
        data = np.frombuffer(text, np.uint8, n + how.length - 1, base)
        hashes = hasher.all(data, how.anchor)
        keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        least, size = keys, 1
        while size * 2 <= how.reach:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < how.reach:
            more = how.reach - size
            least = np.minimum(least[: len(least) - more], least[more:])
        at = (least & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        yield hashes[at[first]].view(np.int64), first + base, np.diff(np.append(first, n)), at[first] - first


CONTEXT = "anchor long, context long, doc long, key long, first int, n int, place int"


def document_contexts(texts: DataFrame, how: Repeats) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SEGMENT + how.length)
        for batch in batches:
            rows: list[int] = []
            parts: list[tuple[np.ndarray, ...]] = []
            names: list[np.ndarray] = []
            for row, text in enumerate(batch.column(2)):
                text = how.units(text.as_py())
                for part in contexts(text, how, hasher) if len(text) >= how.length else ():
                    ends = part[1] + part[2] + how.length - 1
                    spans = zip(part[1].tolist(), ends.tolist(), part[3].tolist())
                    names.append(np.array([xxhash.xxh3_64_intdigest(text[a:b], place) for a, b, place in spans], np.uint64).view(np.int64))
                    parts.append(part)
                    rows += [row] * len(part[0])
            if rows:
                anchor, first, n, place = (np.concatenate(c) for c in zip(*parts))
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(np.concatenate(names)), batch.column(0).take(take), batch.column(1).take(take),
                     *[pa.array(c, pa.int32()) for c in (first, n, place)]],
                    names=["anchor", "context", "doc", "key", "first", "n", "place"])

    return texts.mapInArrow(run, CONTEXT)


# --- the index -----------------------------------------------------------------------------------------------------


def marked_windows(groups: np.ndarray, strings: list[bytes], sizes: np.ndarray, places: np.ndarray, how: Repeats) -> np.ndarray:
    """Which windows (context, column) start a string of `length` that another context of the group has in the same columns.

    groups ascend.  Column 0 is where the earliest possible window of an anchor starts; the anchor is in column reach - 1.
    """
    m, columns = len(strings), how.reach - 1 + how.length
    starts = how.reach - 1 - places
    letters = np.zeros((columns, m), np.int64)  # 0: beyond the context
    for i, (start, string) in enumerate(zip(starts.tolist(), strings)):
        letters[start : start + len(string), i] = np.frombuffer(string, np.uint8)
        letters[start : start + len(string), i] += 1
    order, match = np.arange(m), np.zeros(m, np.int64)  # match: letters shared with the one before in order
    marks = np.zeros((m, how.reach), bool)
    for column in range(columns - 1, -1, -1):
        key = groups[order] * 257 + letters[column, order]
        heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        if len(heads) == m and column >= how.reach:
            order, match = order[np.argsort(key, kind="stable")], _all_heads(key, match)
        else:
            run_keys, lengths = key[heads], np.diff(np.append(heads, m))
            sample = np.minimum.reduceat(match, heads)
            runs = np.argsort(run_keys, kind="stable")
            grown = np.minimum(match + 1, how.length)
            grown[heads[runs[0]]] = 0
            before, after = runs[:-1], runs[1:]
            same = run_keys[before] == run_keys[after]
            grown[heads[after[~same]]] = 0
            if same.any():
                low, high = before[same] + 1, after[same]
                between = np.minimum.reduceat(np.append(sample, 0), np.stack([low, high], 1).ravel())[::2]
                grown[heads[high]] = np.minimum(np.minimum(between, match[heads[high]]) + 1, how.length)
            new = np.repeat(heads[runs], lengths[runs]) + np.arange(m) - np.repeat(np.cumsum(lengths[runs]) - lengths[runs], lengths[runs])
            order, match = order[new], grown[new]
        if column < how.reach:
            long = match >= how.length
            either = long.copy()
            either[:-1] |= long[1:]
            marks[order[either], column] = True
    column = np.arange(how.reach)[None, :]
    return marks & (column >= starts[:, None]) & (column < (starts + sizes)[:, None])


def _all_heads(key: np.ndarray, match: np.ndarray) -> np.ndarray:
    """The lengths after a column in which every row is a run of its own."""
    rows = np.argsort(key, kind="stable")
    out = np.zeros(len(key), np.int64)
    same = np.flatnonzero(key[rows[1:]] == key[rows[:-1]])
    if len(same):
        low, high = rows[same] + 1, rows[same + 1]
        out[same + 1] = np.minimum(np.minimum.reduceat(np.append(match, 0), np.stack([low, high], 1).ravel())[::2], match[high]) + 1
    return out


def _intervals(marks: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], marks.astype(np.int8), [0]))))
    return [{"a": int(a), "b": int(b)} for a, b in zip(edge[::2], edge[1::2])]


_IV = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
MARKED = "anchor long, context long, marks array<struct<a:int,b:int>>"
EXAMPLE = "anchor long, context long, n int, place int, string binary"


def _examples(texts: DataFrame, wanted: DataFrame, how: Repeats) -> DataFrame:
    """The strings of contexts, cut from their documents.  wanted: one example per context, with its document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, found in zip(batch.column(0), batch.column(1)):
                text = how.units(text.as_py())
                rows += [{**{k: c[k] for k in ("anchor", "context", "n", "place")}, "string": text[c["first"] : c["first"] + c["n"] + how.length - 1]} for c in found.as_py()]
                if len(rows) > 5000:
                    yield _record(rows)
                    rows = []
            if rows:
                yield _record(rows)

    lists = wanted.groupBy("doc", "key").agg(F.collect_list(F.struct("anchor", "context", "first", "n", "place")).alias("found"))
    joined = texts.join(lists.withColumnsRenamed({"doc": "d", "key": "k"}), (F.col("doc") == F.col("d")) & (F.col("key") == F.col("k")))
    return joined.select("text", "found").mapInArrow(run, EXAMPLE)


def _record(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema(
        [("anchor", pa.int64()), ("context", pa.int64()), ("n", pa.int32()), ("place", pa.int32()), ("string", pa.binary())]))


def _indexed(examples: DataFrame, buckets: int, how: Repeats) -> DataFrame:
    """Marks of contexts by the index of their bucket."""

    def run(key: tuple, frame: pa.Table) -> pa.Table:
        frame = frame.sort_by("anchor")
        anchors, names = frame.column("anchor").to_numpy(), frame.column("context").to_numpy()
        groups = np.cumsum(np.concatenate(([0], anchors[1:] != anchors[:-1])))
        places, sizes = frame.column("place").to_numpy().astype(np.int64), frame.column("n").to_numpy().astype(np.int64)
        marks = marked_windows(groups, frame.column("string").to_pylist(), sizes, places, how)
        starts = how.reach - 1 - places
        rows = [i for i in np.flatnonzero(marks.any(axis=1))]
        found = [_intervals(marks[i, starts[i] : starts[i] + sizes[i]]) for i in rows]
        return pa.table({"anchor": pa.array(anchors[rows], pa.int64()), "context": pa.array(names[rows], pa.int64()), "marks": pa.array(found, _IV)})

    return examples.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))).groupBy("bucket").applyInArrow(run, MARKED)


def _counted(examples: DataFrame, how: Repeats) -> DataFrame:
    """Marks of contexts of anchors that are too frequent for one task: equal windows are counted by their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(2 * how.length)
        for batch in batches:
            for row in range(batch.num_rows):
                n, place = batch.column(2)[row].as_py(), batch.column(3)[row].as_py()
                windows = hasher.all(np.frombuffer(batch.column(4)[row].as_py(), np.uint8), how.length)
                own = [pa.array(np.full(n, batch.column(c)[row].as_py(), np.int64)) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.arange(n), pa.int32()), pa.array(np.arange(n) - place, pa.int32()), pa.array(windows.view(np.int64))],
                                                 names=["anchor", "context", "at", "column", "window"])

    each = materialize(examples.mapInArrow(run, "anchor long, context long, at int, column int, window long"), "windows")
    same = ["anchor", "column", "window"]
    twice = each.groupBy(*same).agg(F.count("*").alias("times")).filter("times > 1").select(*same)
    marks = F.transform(F.array_sort(F.collect_list("at")), lambda x: F.struct(x.alias("a"), (x + 1).alias("b")))
    return each.join(twice, same, "left_semi").groupBy("anchor", "context").agg(marks.alias("marks"))


# --- documents -----------------------------------------------------------------------------------------------------


def repeated_spans(docs: DataFrame, how: Repeats = Repeats()) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): doc, key and text of every row; doc, key and the windows' starts (a to b, exclusive) that repeat."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("doc"), text_key("text").alias("key"), utf8("text").alias("text"))
    every = materialize(document_contexts(texts, how), "contexts")
    # Written first: in one stage with its count, the join could not split an anchor that has very many rows.
    frequent = every.groupBy("anchor").agg(F.count("*").alias("times")).filter("times > 1").select("anchor")
    frequent = materialize(frequent, "frequent")
    repeated = materialize(every.join(frequent, "anchor", "left_semi"), "repeated")
    one = F.min(F.struct("doc", "key", "first")).alias("one")
    kinds = repeated.groupBy("anchor", "context").agg(F.count("*").alias("times"), F.first("n").alias("n"), F.first("place").alias("place"), one)
    kinds = materialize(kinds.select("anchor", "context", "times", "n", "place", "one.*"), "kinds")
    by_anchor = kinds.groupBy("anchor").agg(F.count("*").alias("different")).filter("different > 1")
    wanted = kinds.join(by_anchor, "anchor")
    sizes = by_anchor.agg(F.sum(F.when(F.col("different") <= how.most, F.col("different"))).alias("n"), F.max("different").alias("largest")).first()
    marked = [kinds.filter("times > 1").select("anchor", "context", F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b"))).alias("marks"))]
    if sizes["n"]:
        examples = _examples(texts, wanted.filter(F.col("different") <= how.most), how)
        marked.append(_indexed(examples, max(1, -(-sizes["n"] // how.bucket)), how))
    if (sizes["largest"] or 0) > how.most:
        marked.append(_counted(_examples(texts, wanted.filter(F.col("different") > how.most), how), how))
    found = marked[0]
    for more in marked[1:]:
        found = found.unionByName(more)
    found = materialize(found, "marks")
    spans = repeated.join(found, ["anchor", "context"]).select("doc", "key", "first", F.explode("marks").alias("m"))
    spans = spans.select("doc", "key", (F.col("first") + F.col("m.a")).alias("a"), (F.col("first") + F.col("m.b")).alias("b"))
    return texts, spans


def merged(starts: list[dict[str, int]], length: int) -> list[tuple[int, int]]:
    """Byte spans covered by windows that start in any of the intervals, joined where they touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["a"], s["b"] - 1 + length) for s in starts):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


REPORT = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()}
PASSAGES = {"n_passage_words": pa.int64(), "n_passages": pa.int64()}


def report(docs: DataFrame, how: Repeats = Repeats(), passage: Repeats | None = None) -> DataFrame:
    """One row per row of `docs`: bytes, bytes removed, maximal removed runs, and the digest of the rest; with `passage`, also the words
    in passages of that many words that stand elsewhere too, and how many such runs of words there are.

    A null text is empty.  Rows that repeat are copies of each other; ids may be null or repeat; other columns take no part.  A very
    long text is read whole, in segments.  No rows give none.
    """
    lists = None
    for name, each in (("starts", how), ("passages", passage)):
        if each:
            spans = repeated_spans(docs, each)[1].distinct()
            found = materialize(spans.groupBy("doc", "key").agg(F.collect_list(F.struct("a", "b")).alias(name)), name)
            lists = lists.join(found, ["doc", "key"], "full") if lists else found
    asked = ["starts", "passages"] if passage else ["starts"]
    lists = materialize(lists, "lists") if passage else lists
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(utf8("text"), F.lit("").cast("binary")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("d"), text_key("text").alias("k"))
    joined = rows.join(lists, (F.col("doc") == F.col("d")) & (F.col("key") == F.col("k")), "left").select("doc_id", "text", *asked)
    schema = pa.schema(list({**REPORT, **(PASSAGES if passage else {})}.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, *starts in zip(*batch.columns[1:]):
                text, digest, at, removed = text.as_py(), hashlib.sha256(), 0, 0
                runs = merged(starts[0].as_py() or [], how.length)
                for a, b in runs:
                    digest.update(text[at:a])
                    at, removed = b, removed + b - a
                digest.update(text[at:])
                words = merged(starts[1].as_py() or [], passage.length) if passage else []
                more = (sum(b - a for a, b in words) // WORD_BYTES, len(words)) if passage else ()
                rows.append((len(text), removed, len(runs), digest.hexdigest(), *more))
            columns = list(zip(*rows)) or [()] * (len(schema) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(list(c), f.type) for c, f in zip(columns, list(schema)[1:])]], schema=schema)

    kinds = {pa.int64(): "long", pa.string(): "string"}
    return joined.mapInArrow(run, ", ".join(f"{f.name} {kinds[f.type]}" for f in schema))
