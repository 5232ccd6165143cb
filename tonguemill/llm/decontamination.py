"""Benchmark decontamination by a distributed positional inverted index.

A window is ten consecutive words of a benchmark item.  The index stores postings (document, position, term) of training
texts.  Of every window the two rarest terms over the whole corpus are its leads; only postings of leads, and of test
terms within a window's reach of a rarest lead, can take part in a match, so only these are stored.  Lists are
intersected from the rarest: postings of the first lead, shifted by its place in the item, meet those of the second, shifted
likewise; what remains is a diagonal (document, item, shift) on which the lists of the other terms in the windows' reach are looked
up.  A run of matches on a diagonal that is at least a window long is an exact occurrence.  The same lists answer proximity: both
leads of a window within `slop` words.

Texts are read twice, in place, and never shuffled: once to count words and test terms, once for the postings.  The benchmark is a
table like any other: items, windows and leads are found by joins and groups of at most a window.  The tasks that read texts only
get a bitmap of the test terms' checksums, of at most `bits` bits whatever the benchmark's size; it lets all test terms through and few
others, which the joins then drop.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonguemill.llm.common import letter_words, text_key, utf8
from tonguemill.session import materialize

WINDOW = 10
SLOP = 20
#: The most bits of a bitmap of terms: 4 MB.  With a million test terms one other word in 33 passes, with ten million one in four.
BITS = 1 << 25
FLUSH = 500_000  # terms a task holds before it passes their counts on

#: What separates words, once A-Z are lower-cased.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DOC = ["doc", "key"]  # doc_id (0 for null) and 64 bits of the text


def keyed(docs: DataFrame) -> DataFrame:
    """doc, key and the text as bytes.  What is found depends on the text alone, so null ids may share 0."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("doc"), text_key("text").alias("key"), utf8("text").alias("text"))


# --- the benchmark -------------------------------------------------------------------------------------------------


def read_items(benchmark: DataFrame) -> DataFrame:
    """item, item_id, size, words: items with their words.  Those without words have no windows; repeated rows are one; an id may
    be null."""
    words = F.filter(F.split(F.translate("text", UPPER, LOWER), BREAK), lambda w: w != "")
    items = benchmark.filter("text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    items = items.select(F.monotonically_increasing_id().alias("item"), "item_id", words.alias("words"))
    return items.withColumn("size", F.size("words")).filter("size > 0")


def term_code(term: str | Column) -> Column:
    """64 bits of a term, which stand for it in the index.  `_code` gives the same in a task."""
    return F.xxhash64(F.col(term) if isinstance(term, str) else term)


def _code(term: bytes) -> int:
    code = xxhash.xxh64_intdigest(term, 42)
    return code - (1 << 64) if code >> 63 else code


class Bitmap:
    """One bit for the checksum of each term: lets these terms through and, of others, those that share a bit."""

    def __init__(self, words: np.ndarray) -> None:
        self.words, self.bits = words, 64 * len(words)

    def passing(self, sums: np.ndarray) -> np.ndarray:
        at = sums & (self.bits - 1)
        return (self.words[at >> 6] >> (at & 63) & 1).astype(bool)


def bitmap(terms: DataFrame, bits: int) -> Bitmap:
    """What reaches the driver are at most `bits` bits, in words of 64; `bits` is a power of two."""
    at = f"crc32(cast(term as binary)) % {bits}"
    words = terms.select(F.expr(f"cast(({at}) div 64 as int)").alias("word"), F.expr(f"shiftleft(1L, cast(({at}) % 64 as int))").alias("bit"))
    words = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(bits // 64, np.int64)
    out[words["word"]] = words["bits"]
    return Bitmap(out)


def _sums(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.int64, len(words))


def leads(places: DataFrame, window: int = WINDOW) -> DataFrame:
    """item, least, a, b, first, around: of every window, the place of the rarest word and of the next rarest, among its words that
    occur; a window of several words of which only one occurs has none.  `around` are the codes of the words from place `first` on
    that share a window with place a.

    places: item, size, place, term, code and n, how often the term stands in all documents.  Each word goes to the windows it stands
    in, so a group is a window and a long item spreads like many short ones.
    """
    least = F.least(F.col("size"), F.lit(window))
    starts = F.sequence(F.greatest(F.lit(0), F.col("place") - least + 1), F.least(F.col("place"), F.col("size") - least))
    found = F.struct("n", "term", "place")
    windows = places.filter("n > 0").select("item", least.alias("least"), F.explode(starts).alias("start"), found.alias("found"))
    windows = windows.groupBy("item", "start").agg(F.first("least").alias("least"), F.array_sort(F.collect_list("found")).alias("found"))
    windows = windows.filter(F.size("found") >= F.least(F.lit(2), F.col("least")))
    second = F.least(F.lit(2), F.col("least"))  # a window of one word has one lead
    pairs = windows.select("item", "least", F.col("found")[0]["place"].alias("a"), F.element_at("found", second)["place"].alias("b")).distinct()
    reach = F.sequence(F.greatest(F.lit(0), F.col("place") - window + 1), F.col("place") + window - 1)
    near = places.select("item", F.explode(reach).alias("a"), F.struct("place", "code").alias("word"))
    near = near.join(pairs.select("item", "a").distinct(), ["item", "a"], "left_semi")
    near = near.groupBy("item", "a").agg(F.array_sort(F.collect_list("word")).alias("words"))
    return pairs.join(near, ["item", "a"]).select(
        "item", "least", "a", "b", F.col("words")[0]["place"].alias("first"), F.transform("words", lambda w: w["code"]).alias("around"))


# --- texts ---------------------------------------------------------------------------------------------------------


def count_words(docs: DataFrame, terms: Bitmap) -> DataFrame:
    """Two kinds of rows: doc_id, doc, key and n_words of every row of `docs`; term and n, occurrences of words that the bitmap lets
    through, in parts that are to be summed."""
    schema = pa.schema([("doc_id", pa.int64()), ("doc", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()), ("term", pa.binary()), ("n", pa.int64())])

    def counts(held: Counter) -> pa.RecordBatch:
        none = [pa.nulls(len(held), pa.int64())] * 4
        return pa.RecordBatch.from_arrays([*none, pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            sizes = []
            for text in batch.column(3):
                words = letter_words(text.as_py())
                sizes.append(len(words))
                if words:
                    held.update([words[i] for i in np.flatnonzero(terms.passing(_sums(words)))])
            none = [pa.nulls(batch.num_rows, pa.binary()), pa.nulls(batch.num_rows, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sizes, pa.int64()), *none], schema=schema)
            if len(held) > FLUSH:
                yield counts(held)
                held.clear()
        yield counts(held)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("doc"),
                        text_key("text").alias("key"), utf8("text").alias("text"))
    return texts.mapInArrow(run, "doc_id long, doc long, key long, n_words long, term binary, n long")


def postings(texts: DataFrame, terms: Bitmap, first: Bitmap, second: Bitmap, reach: int = WINDOW) -> DataFrame:
    """doc, key, pos, code: second leads everywhere, and test terms less than `reach` words away from a first lead.

    All three are bitmaps, so a posting may be of a word that is no test term; no join will find it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, pos, code = [], [], []
            for row, text in enumerate(batch.column(2)):
                words = letter_words(text.as_py())
                if not words:
                    continue
                sums = _sums(words)
                at = np.flatnonzero(first.passing(sums))
                if not len(at):
                    continue
                near = np.zeros(len(words) + 1, np.int64)
                np.add.at(near, np.maximum(0, at - reach + 1), 1)
                np.add.at(near, np.minimum(len(words), at + reach), -1)
                keep = np.flatnonzero(terms.passing(sums) & (np.cumsum(near[:-1]) > 0) | second.passing(sums))
                rows.append(np.full(len(keep), row))
                pos.append(keep)
                code += [_code(words[i]) for i in keep.tolist()]
            if rows:
                take = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(np.concatenate(pos), pa.int32()), pa.array(code, pa.int64())],
                    names=[*DOC, "pos", "code"])

    return texts.mapInArrow(run, "doc long, key long, pos int, code long")


# --- matches -------------------------------------------------------------------------------------------------------


def _found(docs: DataFrame, benchmark: DataFrame, window: int, slop: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """(rows, matches): doc_id, doc, key and n_words of every row of `docs`; the matches of `matches`."""
    items = materialize(read_items(benchmark), "items")
    words = items.select("item", "size", F.posexplode("words").alias("place", "term"))
    vocabulary = materialize(words.select("term").distinct(), "vocabulary")
    bits = min(bits, 1 << max(16, (64 * vocabulary.count()).bit_length()))
    terms = bitmap(vocabulary, bits)
    counted = materialize(count_words(docs, terms), "counts")
    rows = counted.filter("n_words is not null").select("doc_id", *DOC, "n_words")
    held = counted.filter("n is not null").select(F.col("term").cast("string").alias("term"), "n").join(vocabulary, "term", "left_semi")
    held = materialize(held.groupBy("term").agg(F.sum("n").alias("n")), "held")
    places = words.join(held, "term", "left").select("item", "size", "place", "term", term_code("term").alias("code"), F.coalesce("n", F.lit(0)).alias("n"))
    places = materialize(places, "places")
    pairs = materialize(leads(places, window), "leads")
    named = places.select("item", "place", "term", "code")
    lead = lambda place: pairs.select("item", F.col(place).alias("place")).distinct().join(named, ["item", "place"])
    index = postings(keyed(docs), terms, bitmap(lead("a").select("term").distinct(), bits), bitmap(lead("b").select("term").distinct(), bits), window)
    index = materialize(index, "postings")
    coded = pairs.join(lead("a").select("item", F.col("place").alias("a"), F.col("code").alias("code_a")), ["item", "a"])
    coded = coded.join(lead("b").select("item", F.col("place").alias("b"), F.col("code").alias("code_b")), ["item", "b"])
    coded = materialize(coded, "coded")

    # The rarest lead's postings meet the next rarest's in buckets of `slop` words, so that both questions share the join.
    ours = index.join(coded.select("item", "a", "b", "code_a", "code_b"), F.col("code") == F.col("code_a"))
    wanted = ours.select(*DOC, "item", "a", "b", "code_b", F.col("pos").alias("pos_a"),
                         F.explode(F.expr(f"array_distinct(array((pos + b - a) div {slop}, (pos - {slop}) div {slop}, pos div {slop}, (pos + {slop}) div {slop}))")).alias("bucket"))
    there = index.select(*DOC, F.col("code").alias("code_b"), F.col("pos").alias("pos_b"), F.expr(f"pos div {slop}").alias("bucket"))
    met = wanted.join(there, [*DOC, "code_b", "bucket"]).filter(F.expr(f"abs(pos_b - pos_a) <= {slop} or pos_b - pos_a = b - a"))
    met = materialize(met.select(*DOC, "item", "a", (F.col("pos_a") - F.col("a")).alias("shift"), F.expr("pos_b - pos_a = b - a").alias("exact"),
                                 F.expr(f"abs(pos_b - pos_a) <= {slop} and (pos_a <> pos_b or a = b)").alias("near")).distinct(), "met")

    # On a diagonal, the words in reach of its leads are looked up; matches in a row make runs.
    reach = coded.select("item", "a", "least", "first", "around").dropDuplicates(["item", "a"])
    diagonals = met.filter("exact").select(*DOC, "item", "shift", "a").distinct().join(reach, ["item", "a"])
    looked = diagonals.select(*DOC, "item", "shift", "least", "first", F.posexplode("around").alias("nth", "code"))
    looked = looked.select(*DOC, "item", "shift", "least", (F.col("first") + F.col("nth")).alias("place"), "code").distinct()
    looked = looked.withColumn("pos", F.col("shift") + F.col("place")).filter("pos >= 0")
    hits = looked.join(index, [*DOC, "pos", "code"], "left_semi")
    in_order = Window.partitionBy(*DOC, "item", "shift").orderBy("place")
    runs = hits.withColumn("run", F.col("place") - F.row_number().over(in_order)).groupBy(*DOC, "item", "shift", "run")
    runs = runs.agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("end"), F.max("least").alias("least")).filter("end - start >= least")
    names = items.select("item", "item_id")
    exact = runs.join(names, "item").select(*DOC, "item_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    near = met.filter("near").select(*DOC, "item").distinct().join(names, "item")
    near = near.select(*DOC, "item_id", F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("end"))
    return rows, exact.unionByName(near)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP, bits: int = BITS) -> DataFrame:
    """All exact runs (start and end in words) and all proximity matches (start and end null) of items in documents.

    doc is 0 for a null doc_id; key is a hash of the text.  Repeated rows are found once.
    """
    return _found(docs, benchmark, window, slop, bits)[1]


def hits_by_document(found: DataFrame) -> DataFrame:
    """doc, key, hit_words, n_items, items (sorted, comma-joined), n_near; hit_words is 0 for documents with proximity matches
    alone.  A document's runs are at most its own words."""
    exact = found.filter("start is not null")
    # Words inside any run: runs that begin after all earlier ones ended add all their words, others what they add.
    by_start = Window.partitionBy(*DOC).orderBy("start", "end")
    before = F.coalesce(F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    added = exact.select(*DOC, "start", "end").distinct().withColumn("added", F.greatest(F.lit(0), F.col("end") - F.greatest("start", before)))
    hit = added.groupBy(*DOC).agg(F.sum("added").alias("hit_words"))
    items = exact.filter("item_id is not null").select(*DOC, "item_id").distinct().groupBy(*DOC).agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    near = found.filter("start is null").select(*DOC, "item_id").distinct().groupBy(*DOC).agg(F.count("*").alias("n_near"))
    return hit.join(items, DOC, "left").join(near, DOC, "full").select(
        *DOC, F.coalesce("hit_words", F.lit(0)).alias("hit_words"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.array_join("items", ",").alias("items"), F.coalesce("n_near", F.lit(0)).alias("n_near"))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP, bits: int = BITS) -> DataFrame:
    """One row per row of `docs`: n_words, n_hit, n_items, items_sha256, contaminated (and n_near, items with proximity matches).

    Null and empty texts have no words; ids may be null or repeat, rows that repeat get the same result, and other columns take no
    part.  A very long text is read like others; its matches are its own.  No items, or no rows, give no hits.
    """
    rows, found = _found(docs, benchmark, window, slop, bits)
    hits = materialize(hits_by_document(materialize(found, "matches")), "hits")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return rows.join(hits, DOC, "left").select(
        "doc_id", "n_words", zero("hit_words").alias("n_hit"), zero("n_items").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), (zero("hit_words") > 0).alias("contaminated"), zero("n_near").alias("n_near"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP, bits: int = BITS) -> DataFrame:
    """`docs` with its columns, without rows that hold a window of a benchmark item."""
    found = hits_by_document(materialize(matches(docs, benchmark, window, slop, bits), "matches"))
    found = materialize(found.filter("hit_words > 0").select(F.col("doc").alias("__hit_doc"), F.col("key").alias("__hit_key")), "hits")
    named = docs.withColumns({"__doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")), "__key": text_key("text")})
    same = (F.col("__doc") == F.col("__hit_doc")) & (F.col("__key") == F.col("__hit_key"))
    return named.join(found, same, "left_anti").select(*docs.columns)
