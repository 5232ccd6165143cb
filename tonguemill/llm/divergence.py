"""Source divergence audit on run-length columns.

Every source of a language is a column of counts over the language's kept terms.  The vocabulary is put into an order
that clusters equal counts: terms with the same counts in all sources are one entry with a width, and entries are sorted by their
counts.  A column is then stored as runs (start, count), absent terms being runs of 0.  For a pair of columns the run
boundaries are intersected; on each piece both counts are constant, so the divergence is taken once and multiplied by the
piece's length.

The order is cut into sections of bounded size, and sections are worked on by themselves: sums over the vocabulary are sums over
sections.  Texts are counted where they are read; from then on only (language, source, term) counts move.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonguemill.llm.common import utf8
from tonguemill.session import materialize

#: Terms are `[^\x00-\x40\x5B-\x60\x7B-\x7F]+` with A-Z lower-cased: letters, and all bytes of longer characters.
TERM_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
SCALE = 1_000_000_000
LEAST_DOCS = 3
TERM_RANKS = 200
SECTION = 1 << 18  # counts in a section
FLUSH = 1_000_000  # terms a task holds before it passes them on

GROUP = ["lang", "source"]


def term_counts(docs: DataFrame, flush: int = FLUSH) -> DataFrame:
    """lang, source, term, n, docs: occurrences, and rows that hold the term; the term '' stands for the group itself.

    Tasks count before anything is shuffled, so a frequent term or a large source is a row for each task.
    """

    def page(lang: str, source: str, n: Counter, rows: Counter) -> pa.RecordBatch:
        columns = [pa.array([lang] * len(n)), pa.array([source] * len(n)), pa.array(n.keys(), pa.binary()),
                   pa.array(n.values(), pa.int64()), pa.array([rows[t] for t in n], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=[*GROUP, "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in range(2)), batch.column(2)):
                n, rows = held[lang, source]
                words = text.as_py().translate(TERM_BYTES).split()
                n.update(words)
                rows.update(set(words))
                n[b""] += 1
                rows[b""] += 1
            if sum(len(n) for n, _ in held.values()) > flush:
                yield from (page(*group, *counts) for group, counts in held.items())
                held.clear()
        yield from (page(*group, *counts) for group, counts in held.items())

    texts = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in GROUP], utf8(F.coalesce("text", F.lit(""))).alias("text"))
    counted = texts.mapInArrow(run, "lang string, source string, term binary, n long, docs long")
    counted = counted.groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return counted.withColumn("term", F.col("term").cast("string"))


def kept_terms(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, term, total, counts: each kept term with its count in every source of the language that has it, by source."""
    found = F.array_sort(F.collect_list(F.struct("source", "n")))  # at most one entry for each source of the language
    words = counts.filter("term <> ''").groupBy("lang", "term")
    words = words.agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), found.alias("counts"))
    return words.filter(F.col("docs") >= least_docs).drop("docs")


def group_sizes(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, n_source, n_lang, vocabulary: a row for every group, with the occurrences of kept terms."""
    langs = kept.groupBy("lang").agg(F.count("*").alias("vocabulary"), F.sum("total").alias("n_lang"))
    sources = kept.select("lang", F.inline("counts")).groupBy(*GROUP).agg(F.sum("n").alias("n_source"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    every = counts.filter("term = ''").select(*GROUP).join(sources, GROUP, "left").join(langs, "lang", "left")
    return every.select(*GROUP, zero("n_source"), zero("n_lang"), zero("vocabulary"))


def share(count: str, n: str) -> Column:
    """Smoothed share of a term in units of 1/SCALE.  Decimals, as a count times SCALE may exceed 64 bits."""
    part = f"cast({SCALE} as decimal(10,0)) * cast({count} + 1 as decimal(20,0)) div cast({n} + vocabulary as decimal(20,0))"
    return F.expr(f"1 + {part}")


def top_terms(kept: DataFrame, sizes: DataFrame, ranks: int = TERM_RANKS) -> DataFrame:
    """Per group the kept terms it has more of than its language, by divergence: lang, source, item, value, rank.

    Each task ranks its own rows of a group first, so that a group with most of the rows is not sorted in one place.
    """
    each = kept.select("lang", F.col("term").alias("item"), "total", F.inline("counts")).join(sizes, GROUP)
    shares = each.select(*GROUP, "item", share("n", "n_source").alias("p"), share("total", "n_lang").alias("q")).filter("p > q")
    valued = shares.select(*GROUP, "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    best = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    return valued.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= ranks)


# --- run-length columns --------------------------------------------------------------------------------------------

COLUMNS = "lang string, section long, source string, width long, starts array<long>, counts array<long>"


def clusters(kept: DataFrame) -> DataFrame:
    """lang, counts, width: how many terms share the same counts in all sources."""
    return kept.groupBy("lang", "counts").agg(F.count("*").alias("width"))


def runs_of(places: list[int], widths: list[int], counts: list[int], width: int) -> tuple[list[int], list[int]]:
    """Starts and counts of the runs of a column: it has `counts` on [place, place + width), ascending, and 0 elsewhere."""
    starts, values, at = [], [], 0

    def add(start: int, count: int) -> None:
        if not values or values[-1] != count:
            starts.append(start)
            values.append(count)

    for place, wide, count in zip(places, widths, counts):
        if place > at:
            add(at, 0)
        add(place, count)
        at = place + wide
    if at < width:
        add(at, 0)
    return starts, values


def run_columns(grouped: DataFrame, section: int = SECTION) -> DataFrame:
    """The columns of every section of the sorted vocabulary, a row for each source that occurs in it.

    A section ends after about `section` counts, with a language, or with a task.
    """

    def encode(lang: str, number: int, entries: list[tuple[list, int]]) -> Iterator[tuple]:
        columns: defaultdict[str, tuple[list, list, list]] = defaultdict(lambda: ([], [], []))
        at = 0
        for counts, width in entries:
            for entry in counts:
                for held, value in zip(columns[entry["source"]], (at, width, entry["n"])):
                    held.append(value)
            at += width
        for source, column in columns.items():
            yield (lang, number, source, at, *runs_of(*column, at))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        rows = ((r["lang"], r["counts"], r["width"]) for b in batches for r in b.to_pylist())
        number = 0
        for lang, mine in groupby(rows, key=lambda r: r[0]):
            held: list[tuple[list, int]] = []
            size = 0
            for _, counts, width in mine:
                held.append((counts, width))
                size += len(counts)
                if size >= section:
                    yield record(encode(lang, first + number, held))
                    held, size, number = [], 0, number + 1
            if held:
                yield record(encode(lang, first + number, held))
                number += 1

    schema = pa.schema([("lang", pa.string()), ("section", pa.int64()), ("source", pa.string()), ("width", pa.int64()),
                        ("starts", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])

    def record(rows: Iterator[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    grouped = materialize(grouped, "clusters")
    n = grouped.agg(F.sum(F.size("counts"))).first()[0] or 0
    parts = max(1, -(-n // section))
    ordered = grouped.repartitionByRange(parts, "lang", "counts").sortWithinPartitions("lang", "counts")
    return ordered.select("lang", "counts", "width").mapInArrow(run, COLUMNS)


def _shares(counts: np.ndarray, n: int, vocabulary: int) -> np.ndarray:
    if len(counts) and int(counts.max()) >= (1 << 63) // SCALE - 1:  # beyond 64 bits
        return np.array([1 + SCALE * (int(c) + 1) // (n + vocabulary) for c in counts], np.int64)
    return 1 + SCALE * (counts + 1) // (n + vocabulary)


def intersected(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], width: int) -> tuple[np.ndarray, ...]:
    """The pieces between the run boundaries of two columns: their lengths and both columns' values."""
    starts = np.union1d(a[0], b[0])
    lengths = np.diff(np.append(starts, width))
    return lengths, a[1][np.searchsorted(a[0], starts, "right") - 1], b[1][np.searchsorted(b[0], starts, "right") - 1]


def _section_pairs(key: tuple, frame: pa.Table) -> pa.Table:
    """Both divergences of every pair of sources over one section.  The rows are the language's groups with their columns."""
    rows = sorted(frame.to_pylist(), key=lambda r: r["source"])
    width = next(r["width"] for r in rows if r["width"] is not None)
    columns = []
    for r in rows:
        starts = np.array([0] if r["starts"] is None else r["starts"], np.int64)
        counts = np.array([0] if r["counts"] is None else r["counts"], np.int64)
        columns.append((starts, _shares(counts, r["n_source"], r["vocabulary"])))
    out: list[tuple[str, str, str, int]] = []
    for i, a in enumerate(columns):
        for j in range(i):
            lengths, p, q = intersected(a, columns[j], width)
            square = (p - q) * (p - q)
            mine, other = rows[i]["source"], rows[j]["source"]
            out.append((rows[i]["lang"], mine, other, int((square // q * lengths).sum())))
            out.append((rows[i]["lang"], other, mine, int((square // p * lengths).sum())))
    kinds = [pa.string()] * 3 + [pa.int64()]
    columns_out = list(zip(*out)) or [()] * 4
    return pa.table([pa.array(list(c), k) for c, k in zip(columns_out, kinds)], names=[*GROUP, "item", "value"])


def pair_divergence(columns: DataFrame, sizes: DataFrame) -> DataFrame:
    """lang, source, item, value, rank: every other source of the language by how far the source diverges from it.

    A section comes with all groups of its language, also those without a term in it; a section is bounded, and the pairs are
    the result itself.
    """
    columns = materialize(columns, "columns")
    sections = columns.select("lang", "section").distinct()
    headed = sizes.drop("n_lang").join(sections, "lang").join(columns, ["lang", "section", "source"], "left")
    pairs = headed.groupBy("lang", "section").applyInArrow(_section_pairs, "lang string, source string, item string, value long")
    bare = sizes.filter("vocabulary = 0").select(*GROUP)  # languages without kept terms have no section
    others = bare.withColumnRenamed("source", "item")
    empty = bare.join(others, "lang").filter("source <> item").select(*GROUP, "item", F.lit(0).cast("long").alias("value"))
    summed = pairs.groupBy(*GROUP, "item").agg(F.sum("value").alias("value")).unionByName(empty)
    return summed.withColumn("rank", F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")))


def audit(docs: DataFrame, section: int = SECTION) -> DataFrame:
    """lang, source, part, item, value, rank: part `pair` against the other sources, part `term` the terms that set a group apart.

    Null lang, source and text are ''.  Equal values rank by item; repeated rows count as often as they stand there, ids and other
    columns take no part.  A group without terms takes part with counts of 0.  A very long text costs its own length.  No rows
    give none.
    """
    counts = materialize(term_counts(docs), "counts")
    kept = materialize(kept_terms(counts), "kept")
    sizes = materialize(group_sizes(counts, kept), "sizes")
    pairs = pair_divergence(run_columns(clusters(kept), section), sizes).withColumn("part", F.lit("pair"))
    terms = top_terms(kept, sizes).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).select(*GROUP, "part", "item", "value", "rank")
