"""Exact top-k search on a bit-sliced index.

Vectors are quantised to integers.  A block of the index stores, for every attribute, one bitmap of rows per bit ("slice") of its
coarse value, the value without its low bits; blocks are built once and read by every chunk of queries.  For a query, the slices of all attributes are added with bitmap
arithmetic (carry-save adders), each as often as the query's component has a binary digit set, which gives the slices of
every row's coarse score.  The k-th coarse score is found from the most significant slice downward, and so are
the rows that may be as good once the low bits count; only these boundary rows are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonguemill.session import materialize


@dataclass(frozen=True)
class Index:
    """k: rows asked for; scale: components become floor(scale * x); dropped: low bits that slices leave out;
    block_rows: rows in a block of the index; chunk: queries that a block answers in one task."""

    k: int = 5
    scale: int = 256
    dropped: int = 3
    block_rows: int = 32_768
    chunk: int = 1024


INDEXED = "block int, ids array<long>, values binary, width int, bytes int, low binary, bits binary, slices binary"
FOUND = "query long, query_id long, vec_id long, score long, own long"


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id and the integer vector of every row.  Vectors that are null, or hold null or non-finite components, take no part."""
    finite = F.col("embedding").isNotNull() & ~F.coalesce(
        F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))), F.lit(False))
    value = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return vectors.filter(finite).select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("v"))


def _matrix(lists: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows, in the narrowest integers that hold them; shorter ones end in zeros."""
    lists = lists.combine_chunks()
    sizes, flat = pc.list_value_length(lists).to_numpy(zero_copy_only=False), lists.flatten().to_numpy()
    width = int(sizes.max(initial=0))
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    kind = next(k for k in (np.int16, np.int32, np.int64) if not out.size or np.iinfo(k).min <= out.min() and out.max() <= np.iinfo(k).max)
    return out.astype(kind)


def build_index(vectors: DataFrame, how: Index) -> DataFrame:
    """One row per block: ids and integer vectors in order of id, null ids last, and the slices.  Rows are dealt by a hash and, so that
    copies do not meet in one block, by a number of their own."""
    numbered = materialize(vectors.withColumn("n", F.monotonically_increasing_id()), "numbered")
    blocks = max(1, -(-numbered.count() // how.block_rows))

    def run(key: tuple, frame: pa.Table) -> pa.Table:
        ids = frame.column("vec_id")
        order = np.lexsort((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy()))
        ids, values = ids.take(pa.array(order)).combine_chunks(), _matrix(frame.column("v"))[order]
        block = Block.build(values, how.dropped)
        slices = [s for mine in block.slices for s in mine]
        return pa.table({
            "block": pa.array([key[0].as_py()], pa.int32()), "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            "values": pa.array([values.tobytes()], pa.binary()), "width": pa.array([values.shape[1]], pa.int32()),
            "bytes": pa.array([values.itemsize], pa.int32()), "low": pa.array([block.low.astype(np.int64).tobytes()], pa.binary()),
            "bits": pa.array([bytes(block.bits)], pa.binary()), "slices": pa.array([b"".join(s.tobytes() for s in slices)], pa.binary())})

    dealt = numbered.select("vec_id", "v", F.pmod(F.xxhash64("vec_id", "v", "n"), F.lit(blocks)).cast("int").alias("block"))
    return dealt.groupBy("block").applyInArrow(run, INDEXED)


class Block:
    """A block of the index in memory: exact values, and bitmaps of the coarse ones."""

    def __init__(self, values: np.ndarray, low: np.ndarray, bits: list[int], dropped: int) -> None:
        self.values, self.low, self.bits, self.dropped = values.astype(np.int64), low, bits, dropped
        self.words = -(-len(values) // 64)
        self.full = self._bitmap(np.ones(len(values), bool))
        self.slices: list[list[np.ndarray]] = []

    @classmethod
    def build(cls, values: np.ndarray, dropped: int) -> Block:
        values = values.astype(np.int64)
        low = values.min(axis=0, initial=0)
        shifted = (values - low) >> dropped
        self = cls(values, low, [int(c).bit_length() for c in shifted.max(axis=0, initial=0)], dropped)
        self.slices = [[self._bitmap((shifted[:, d] >> b) & 1) for b in range(n)] for d, n in enumerate(self.bits)]
        return self

    @classmethod
    def stored(cls, row: dict, dropped: int) -> Block:
        values = np.frombuffer(row["values"], f"i{row['bytes']}").reshape(len(row["ids"]), row["width"])
        self = cls(values, np.frombuffer(row["low"], np.int64), list(row["bits"]), dropped)
        slices = iter(np.frombuffer(row["slices"], np.uint64).reshape(-1, self.words) if sum(self.bits) else ())
        self.slices = [[next(slices) for _ in range(n)] for n in self.bits]
        self.inverse = [[self.full & ~s for s in mine] for mine in self.slices]
        return self

    def _bitmap(self, rows: np.ndarray) -> np.ndarray:
        packed = np.packbits(rows.astype(bool), bitorder="little")
        return np.frombuffer(packed.tobytes().ljust(self.words * 8, b"\0"), np.uint64)

    def coarse_sum(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of sum over d of |q_d| * c_d, with c_d the coarse value, or its complement where q_d is negative."""
        piles: list[list[np.ndarray]] = []
        for d, q in enumerate(query.tolist()):
            mine = (self.slices if q > 0 else self.inverse)[d]
            weight, at = abs(q), 0
            while weight:
                if weight & 1:
                    while len(piles) < at + len(mine):
                        piles.append([])
                    for b, s in enumerate(mine):
                        piles[at + b].append(s)
                weight >>= 1
                at += 1
        out, at = [], 0
        while at < len(piles):
            pile = piles[at]
            if at + 1 == len(piles) and len(pile) > 1:
                piles.append([])
            while len(pile) > 2:  # three of a weight make one of it and one of the next
                a, b, c = pile.pop(), pile.pop(), pile.pop()
                half = a ^ b
                pile.append(half ^ c)
                piles[at + 1].append((a & b) | (half & c))
            if len(pile) == 2:
                a, b = pile
                piles[at + 1].append(a & b)
                pile = [a ^ b]
            out.append(pile[0] if pile else np.zeros(self.words, np.uint64))
            at += 1
        return out

    def top(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The block's k best rows, earlier ones first among equals, and their exact scores."""
        width = self.values.shape[1]
        query = query[:width]
        query = np.pad(query, (0, width - len(query)))
        rows = self._candidates(self.coarse_sum(query), int(np.abs(query).sum()) * ((1 << self.dropped) - 1), self.full, k)
        scores = self.values[rows] @ query
        best = np.lexsort((rows, -scores))[:k]
        return rows[best], scores[best]

    def _candidates(self, slices: list[np.ndarray], slack: int, alive: np.ndarray, k: int) -> np.ndarray:
        """Rows whose coarse score is within the slack of the k-th best: the low bits decide among them."""
        sure, tied, value = np.zeros(self.words, np.uint64), alive, 0
        count = lambda bitmap: int(np.bitwise_count(bitmap).sum())
        if count(alive) <= k:
            return self._rows(alive)
        for b in range(len(slices) - 1, -1, -1):
            hit = tied & slices[b]
            if count(sure | hit) >= k:
                tied, value = hit, value | 1 << b
            else:
                sure, tied = sure | hit, tied & ~slices[b]
        # `value` is the k-th best coarse score; low bits add at most `slack` to any.
        least = max(0, value - -(-slack >> self.dropped) - 1)
        above, equal = np.zeros(self.words, np.uint64), alive
        for b in range(max(len(slices), least.bit_length()) - 1, -1, -1):
            s = slices[b] if b < len(slices) else np.zeros(self.words, np.uint64)
            if least >> b & 1:
                equal = equal & s
            else:
                above, equal = above | (equal & s), equal & ~s
        return self._rows(above | equal)

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[: len(self.values)])


def search(vectors: DataFrame, queries: DataFrame, how: Index = Index()) -> DataFrame:
    """query_id, rank, vec_id and score: the k best rows of `vectors` for every row of `queries`, ties to the smaller id.

    Both hold vec_id and embedding; other columns take no part.  Rows are candidates of their own, also where they repeat or have no
    id (these come last among equal scores); a query is not answered by its own row, but by copies of it.  Queries that repeat are
    answered each.  Vectors that are null or hold null or non-finite components take no part, shorter ones are read as ending in zeros,
    and a very long one makes its block as wide.  No rows on either side give none.

    Every block of the index meets every chunk of queries, in a group of its own that holds one block and at most about
    `chunk` queries; it returns k + 1 rows per query, of which the best are kept.  The query's own row is one with its id and the
    score of the query with itself; it is left out once, at the end.
    """
    index = materialize(build_index(quantised(vectors, how.scale), how), "index")
    asked = materialize(quantised(queries, how.scale).withColumn("query", F.monotonically_increasing_id()), "queries")
    chunks, blocks = max(1, -(-asked.count() // how.chunk)), max(1, index.count())
    chunk = F.pmod(F.xxhash64("query"), F.lit(chunks)).cast("int")
    stored = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    asked = asked.withColumn("chunk", chunk).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            row, queries = left.to_pylist()[0], _matrix(right.column("v")).astype(np.int64)
            block, ids = Block.stored(row, how.dropped), row["ids"]
            for number, query_id, query in zip(right.column("query").to_pylist(), right.column("vec_id").to_pylist(), queries):
                rows, scores = block.top(query, how.k + 1)  # one may be the query's own
                own = int(query @ query)
                found += [(number, query_id, ids[r], s, own) for r, s in zip(rows.tolist(), scores.tolist())]
        columns = list(zip(*found)) or [()] * 5
        return pa.table({n: pa.array(list(c), pa.int64()) for n, c in zip(("query", "query_id", "vec_id", "score", "own"), columns)})

    found = stored.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInArrow(run, FOUND)
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    found = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= how.k + 1)
    own = F.col("query_id").eqNullSafe(F.col("vec_id")) & (F.col("score") == F.col("own"))
    so_far = F.count_if("mine").over(Window.partitionBy("query").orderBy("place"))
    found = found.withColumn("mine", own).withColumn("so_far", so_far).filter(~(F.col("mine") & (F.col("so_far") == 1)))
    rank = (F.col("place") - F.least(F.lit(1), F.col("so_far"))).cast("int")
    return found.withColumn("rank", rank).filter(F.col("rank") <= how.k).select("query_id", "rank", "vec_id", "score")
