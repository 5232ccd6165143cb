"""Ranked lexical search with range-maximum tables over the posting lists.

Documents are numbered by id within a shard, and every term of a shard has a posting list of (document, occurrences).  Once the
statistics of the corpus are known, each posting has an impact, and each list a sparse table that answers the largest impact in any
interval of documents, and where it stands, with two look-ups.  The sum of these answers over an item's lists bounds every score
in the interval.  Intervals are opened best first: the document with the largest impact is scored exactly (the bound of an interval of
one document), and the interval is split there.  Intervals that cannot reach the best `top` so far are never opened.

Texts are read once, by the tasks that write their shards; postings of the items' terms alone are shuffled.  Items are dealt into
blocks of about `block_words` words, and a block meets every shard; a shard hands on its best `top` documents per item.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonguemill.llm.common import letter_words, utf8
from tonguemill.session import materialize

#: What separates terms, once A-Z are lower-cased.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Search:
    top: int = 50
    shard_words: int = 4_000_000
    shard_docs: int = 1 << 16
    block_words: int = 20_000
    opened: int = 512  # intervals opened at a time
    table_bytes: int = 1 << 26  # sparse tables a task keeps; others are built again when an item needs them


# --- the index -----------------------------------------------------------------------------------------------------

INDEX = "shard long, term string, places array<int>, times array<int>, ids array<long>, n_docs long, n_words long"


def build_index(docs: DataFrame, how: Search = Search()) -> DataFrame:
    """Posting lists of every term of every shard, and for each shard a row with term '': its documents' ids and lengths.

    A shard is what a task reads until it holds `shard_words` words or `shard_docs` rows.  Rows are documents, repeated ones too.
    """
    schema = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("places", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())),
                        ("ids", pa.list_(pa.int64())), ("n_docs", pa.int64()), ("n_words", pa.int64())])

    def shard_rows(shard: int, names: list[bytes], ids: list, lengths: list[int], codes: list, times: list) -> Iterator[pa.RecordBatch]:
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        place = np.empty(len(ids), np.int32)
        place[order] = np.arange(len(ids), dtype=np.int32)
        lengths_in_order = [lengths[i] for i in order]
        header = [[shard], [""], [None], [lengths_in_order], [[ids[i] for i in order]], [sum(n > 0 for n in lengths)], [sum(lengths)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(header, schema)], schema=schema)
        if not names:
            return
        code, often = np.concatenate(codes), np.concatenate(times)
        where = np.repeat(place, [len(c) for c in codes])
        by_term = np.lexsort((where, code))
        ends = np.cumsum(np.bincount(code, minlength=len(names)))
        where, often = where[by_term], often[by_term]
        for a in range(0, len(names), 4096):
            b = min(a + 4096, len(names))
            low, high = int(ends[a - 1]) if a else 0, int(ends[b - 1])
            offsets = pa.array(np.concatenate(([low], ends[a:b])) - low, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x[low:high], pa.int32())) for x in (where, often)]
            none = [pa.nulls(b - a, f.type) for f in list(schema)[4:]]
            words = pa.array(names[a:b], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(b - a, shard)), words, *lists, *none], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32

        def fresh() -> tuple:
            return defaultdict(count().__next__), [], [], [], []

        vocabulary, ids, lengths, codes, times = fresh()
        words_held = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = letter_words(text.as_py())
                found = Counter(words)
                ids.append(doc)
                lengths.append(len(words))
                codes.append(np.fromiter(map(vocabulary.__getitem__, found), np.int32, len(found)))
                times.append(np.fromiter(found.values(), np.int32, len(found)))
                words_held += len(words)
                if words_held >= how.shard_words or len(ids) >= how.shard_docs:
                    yield from shard_rows(shard, list(vocabulary), ids, lengths, codes, times)
                    vocabulary, ids, lengths, codes, times = fresh()
                    words_held, shard = 0, shard + 1
        if ids:
            yield from shard_rows(shard, list(vocabulary), ids, lengths, codes, times)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text")).mapInArrow(run, INDEX)


def read_items(benchmark: DataFrame, how: Search = Search()) -> tuple[DataFrame, int]:
    """no, item_id, terms, block, and the number of blocks: rows alike in id and text are one item; a null text has no terms.

    Items are dealt to blocks by a hash, so that a block has about `block_words` words.
    """
    words = F.filter(F.split(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), BREAK), lambda w: w != "")
    items = benchmark.select("item_id", "text").distinct().select(F.monotonically_increasing_id().alias("no"), "item_id", F.array_distinct(words).alias("terms"))
    items = materialize(items, "items")
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-total // how.block_words))
    return items.withColumn("block", F.pmod(F.xxhash64("no"), F.lit(blocks)).cast("int")), blocks


# --- range maxima --------------------------------------------------------------------------------------------------


class RangeMaximum:
    """A posting list's impacts with a sparse table of places of maxima: level k covers 2^k postings from each place on."""

    def __init__(self, places: np.ndarray, impacts: np.ndarray, n_docs: int) -> None:
        self.places, self.impacts = places, impacts
        self.before = np.zeros(n_docs + 1, np.int32)  # postings of documents below a number
        self.before[places + 1] = 1
        np.cumsum(self.before, out=self.before)
        self.levels = [np.arange(len(places), dtype=np.int32)]
        half = 1
        while 2 * half <= len(places):
            low, high = self.levels[-1][:-half], self.levels[-1][half:]
            self.levels.append(np.where(impacts[low] >= impacts[high], low, high))
            half *= 2
        self.starts = np.cumsum([0] + [len(x) for x in self.levels])[:-1]
        self.flat = np.concatenate(self.levels)
        self.n_bytes = self.before.nbytes + 2 * self.flat.nbytes + impacts.nbytes + places.nbytes
        self.levels = []

    def largest(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For intervals of documents [low, high): the largest impact, 0 without a posting, and the first document that has it."""
        a, b = self.before[low], self.before[high]
        found = np.flatnonzero(b > a)
        impact, doc = np.zeros(len(low), np.int64), low.copy()
        a, b = a[found], b[found]
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        start = self.starts[level]
        left, right = self.flat[start + a], self.flat[start + b - (1 << level)]
        best = np.where(self.impacts[left] >= self.impacts[right], left, right)
        impact[found], doc[found] = self.impacts[best], self.places[best]
        return impact, doc


def bounds(lists: list[RangeMaximum], low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the lists' maxima in each interval, and the document with the largest impact of all lists."""
    total, most, split = np.zeros(len(low), np.int64), np.full(len(low), -1, np.int64), low.copy()
    for each in lists:
        impact, doc = each.largest(low, high)
        total += impact
        better = impact > most
        most[better], split[better] = impact[better], doc[better]
    return total, split


def best_documents(lists: list[RangeMaximum], n_docs: int, how: Search) -> tuple[np.ndarray, np.ndarray]:
    """The `top` documents of a shard by score, equal scores by number, and their scores; scores of 0 are none."""
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, high = np.zeros(1, np.int64), np.full(1, n_docs, np.int64)
    bound, split = bounds(lists, low, high)
    while True:
        keep = bound > 0
        if len(docs) == how.top:  # what is left must beat the last of the best
            keep &= (bound > scores[-1]) | ((bound == scores[-1]) & (low < docs[-1]))
        low, high, bound, split = low[keep], high[keep], bound[keep], split[keep]
        if not len(low):
            return docs, scores
        pick = np.argpartition(-bound, how.opened)[: how.opened] if len(low) > how.opened else np.arange(len(low))
        at = split[pick]
        new_low, new_high = np.concatenate([at, low[pick], at + 1]), np.concatenate([at + 1, at, high[pick]])
        new_bound, new_split = bounds(lists, new_low, new_high)
        n = len(pick)
        docs, scores = np.concatenate([docs, at]), np.concatenate([scores, new_bound[:n]])
        order = np.lexsort((docs, -scores))[: how.top]
        order = order[scores[order] > 0]
        docs, scores = docs[order], scores[order]
        rest = np.ones(len(low), bool)
        rest[pick] = False
        low, high = np.concatenate([low[rest], new_low[n:]]), np.concatenate([high[rest], new_high[n:]])
        bound, split = np.concatenate([bound[rest], new_bound[n:]]), np.concatenate([split[rest], new_split[n:]])


# --- search --------------------------------------------------------------------------------------------------------

FOUND = "no long, doc_id long, score long"


def _searched(met: DataFrame, n_docs: int, n_words: int, how: Search) -> DataFrame:
    """The best documents per shard and item.  met: lists of a block's terms with weights, and the shard's header with the items."""

    def run(key: tuple, frame: pa.Table) -> pa.Table:
        heads = np.array([t == "" for t in frame.column("term").to_pylist()])
        header = frame.filter(pa.array(heads)).to_pylist()[0]
        lists = frame.filter(pa.array(~heads))
        ids, lengths = header["ids"], np.array(header["times"], np.int64)
        middle = 100 - 50 + (50 * lengths * n_docs) // n_words if n_words else lengths
        row_of = {t: i for i, t in enumerate(lists.column("term").to_pylist())}
        weights = lists.column("w").to_pylist()
        built: dict[str, RangeMaximum] = {}

        def table(term: str) -> RangeMaximum:
            if term not in built:
                if sum(t.n_bytes for t in built.values()) > how.table_bytes:
                    built.clear()
                i = row_of[term]
                places = np.array(lists.column("places")[i].values, np.int64)
                times = np.array(lists.column("times")[i].values, np.int64)
                impacts = weights[i] * ((1_000_000_000 * times) // (1000 * times + 20 * middle[places]))
                built[term] = RangeMaximum(places, impacts, len(ids))
            return built[term]

        out: list[tuple] = []
        for item in header["items"]:
            mine = [table(t) for t in item["terms"] if t in row_of]
            if mine:
                docs, scores = best_documents(mine, len(ids), how)
                out += [(item["no"], ids[d], s) for d, s in zip(docs.tolist(), scores.tolist())]
        columns = list(zip(*out)) or [()] * 3
        return pa.table([pa.array(list(c), pa.int64()) for c in columns], names=["no", "doc_id", "score"])

    return met.groupBy("shard", "block").applyInArrow(run, FOUND)


def search(docs: DataFrame, benchmark: DataFrame, how: Search = Search()) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` documents of every item with a score above 0, equal scores by doc_id.

    Null and empty texts have no terms: such documents are found by no item, and such items find none.  Repeated rows of `docs`
    are documents of their own; null ids rank last among equal scores.  Rows of `benchmark` alike in id and text are one item.
    Other columns take no part, a very long text is a document like others, and no rows on either side give none.
    """
    index = materialize(build_index(docs, how), "index")
    items, blocks = read_items(benchmark, how)
    headers = index.filter("term = ''")
    whole = headers.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("n_words"), F.lit(0)).alias("words")).first()
    wanted = materialize(items.select("block", F.explode("terms").alias("term")).distinct(), "wanted")
    lists = index.filter("term <> ''").select("shard", "term", "places", "times")
    lists = materialize(lists.join(wanted.select("term").distinct(), "term"), "lists")
    held = lists.groupBy("term").agg(F.sum(F.size("places")).cast("long").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2 * whole["docs"] + 2)).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weights = materialize(wanted.join(held, "term").select("block", "term", weight.alias("w")).filter("w > 0"), "weights")
    of_block = items.groupBy("block").agg(F.collect_list(F.struct("no", "terms")).alias("items"))  # bounded by block_words
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    item_type = "array<struct<no:bigint,terms:array<string>>>"
    met = lists.join(weights, "term").select("shard", "block", "term", "w", "places", "times", none("array<bigint>", "ids"), none(item_type, "items"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    heads = headers.select("shard", "times", "ids", every).join(materialize(of_block, "blocks"), "block")
    heads = heads.select("shard", "block", F.lit("").alias("term"), none("bigint", "w"), none("array<int>", "places"), "times", "ids", "items")
    found = _searched(met.unionByName(heads), whole["docs"], whole["words"], how)
    order = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= how.top)
    return best.join(items.select("no", "item_id"), "no").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
