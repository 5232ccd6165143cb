"""Near-duplicates by b-bit MinHash.

A document is the set of its distinct five-word shingles.  Documents with equal sets form a class, and only one of a class
goes on.  Its signature keeps the low b bits of each minimum, packed into longs; bands of whole minima, hashed, give
candidates: in every bucket of a band the members are compared with one pivot, never all with all.  The
similarity of a candidate pair is estimated from the number of equal bit groups, corrected for the 2^-b that agree by chance;
pairs whose estimate is hopeless are dropped, all others are confirmed on the full sets.

The pivot is the member that shares most buckets, which is the one nearest to what a group of copies was made from.  A bucket
whose other members then lie in several components is open: a pair in it could still link them.  Of an open bucket
those members leave whose shingles that nobody else has are too many for any partner of a size that is there; the
others meet a second pivot, and so on.  What is open after some rounds is compared exactly in blocks of bounded size, so no pair
of a bucket that could join two components stays untried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonguemill.llm.common import blank_words, text_key, utf8
from tonguemill.llm.components import components
from tonguemill.session import materialize


@dataclass(frozen=True)
class MinHash:
    """percent: least similarity in hundredths.  bands x rows minima; bits kept of each; margin: how far below the least
    similarity an estimate may be (five standard deviations of 128 minima at 0.75)."""

    shingle: int = 5
    percent: int = 75
    bands: int = 32
    rows: int = 4
    bits: int = 4
    margin: float = 0.2
    seed: int = 5

    @property
    def minima(self) -> int:
        return self.bands * self.rows

    @property
    def longs(self) -> int:
        return self.minima * self.bits // 64

    def multipliers(self) -> np.ndarray:
        return np.random.default_rng(self.seed).integers(0, 1 << 32, self.minima, np.uint32) | np.uint32(1)


def shingles(text: bytes | None, size: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; all words are one shingle if there are fewer; none without words."""
    words = blank_words(text)
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return np.unique(_rolled(each, size))


def _rolled(each: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of `size` word hashes; every step mixes, so order counts."""
    n = len(each) - size + 1
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + each[k : k + n])
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def signatures(sets: list[np.ndarray], how: MinHash, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes and packed low bits of the minima, a row per (non-empty) set, as signed longs."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    x = np.concatenate(sets).astype(np.uint32)
    least = np.empty((how.minima, len(sets)), np.uint32)
    for k, a in enumerate(factors):
        least[k] = np.minimum.reduceat(x * a, starts)
    # Low bits of a product hang on low bits alone, so minima are mixed before their low bits are taken.
    mixed = _mixed(least.T.astype(np.uint64) + np.uint64(1))
    hashed = np.broadcast_to(np.arange(1, how.bands + 1, dtype=np.uint64), (len(sets), how.bands))
    for k in range(how.rows):
        hashed = _mixed(hashed * np.uint64(0x9E3779B97F4A7C15) + mixed[:, k :: how.rows])
    low = (mixed & np.uint64((1 << how.bits) - 1)).reshape(len(sets), how.longs, 64 // how.bits)
    packed = np.bitwise_or.reduce(low << (np.arange(64 // how.bits, dtype=np.uint64) * np.uint64(how.bits)), axis=2)
    return hashed.view(np.int64), packed.view(np.int64)


def similarity_estimate(a: Column, b: Column, how: MinHash) -> Column:
    """Share of equal b-bit groups, corrected for those that agree by chance."""
    spread = sum(1 << (how.bits * k) for k in range(64 // how.bits))
    signed = spread - (1 << 64) if spread >= 1 << 63 else spread

    def differing(x: Column, y: Column) -> Column:
        bits = x.bitwiseXOR(y)
        folded = bits
        for k in range(1, how.bits):
            folded = folded.bitwiseOR(F.shiftrightunsigned(bits, k))
        return F.bit_count(folded.bitwiseAND(F.lit(signed).cast("long")))

    unequal = sum((differing(a[k], b[k]) for k in range(how.longs)), F.lit(0))
    chance = 2.0**-how.bits
    return (1 - unequal / how.minima - chance) / (1 - chance)


SIGNED = "doc long, key long, n long, class binary, packed array<long>, bands array<long>"
CHUNK = 50_000  # shingles whose minima are taken together


def signed_documents(docs: DataFrame, how: MinHash) -> DataFrame:
    """One row per row of `docs`: set size, the class (a digest of the set), signature and bands (null without a set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = how.multipliers()
        for batch in batches:
            sizes, classes, packed, bands = [], [], [None] * batch.num_rows, [None] * batch.num_rows
            sets: list[np.ndarray] = []
            rows: list[int] = []

            def flush() -> None:
                if sets:
                    for row, hashed, low in zip(rows, *signatures(sets, how, factors)):
                        bands[row], packed[row] = hashed, low
                    sets.clear()
                    rows.clear()

            held = 0
            for row, text in enumerate(batch.column(2)):
                own = shingles(text.as_py(), how.shingle)
                sizes.append(len(own))
                classes.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                if len(own):
                    sets.append(own)
                    rows.append(row)
                    held += len(own)
                    if held > CHUNK:
                        flush()
                        held = 0
            flush()
            arrays = [pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(packed, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["doc", "key", "n", "class", "packed", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), text_key("text").alias("key"), utf8("text").alias("text"))
    return rows.mapInArrow(run, SIGNED)


def confirmed(pairs: DataFrame, texts: DataFrame, how: MinHash) -> DataFrame:
    """Of pairs u, v those whose full sets are similar enough.  texts: id and the text as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, b = None, None  # rows come in the order of v
        for batch in batches:
            keep = []
            for one, v, other in zip(batch.column(2), batch.column(1).to_pylist(), batch.column(3)):
                a, text = shingles(one.as_py(), how.shingle), other.as_py()
                if (v, text) != last:
                    last, b = (v, text), shingles(text, how.shingle)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= how.percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    left = pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("text_u")), "u")
    full = left.join(texts.select(F.col("id").alias("v"), F.col("text").alias("text_v")), "v")
    return full.select("u", "v", "text_u", "text_v").mapInArrow(run, "u long, v long").distinct()


def own_shingles(texts: DataFrame, how: MinHash) -> DataFrame:
    """id and `own`, the number of its shingles that no other of the texts has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in enumerate(batch.column(1)):
                own = shingles(text.as_py(), how.shingle)
                ids = pa.array(np.full(len(own), batch.column(0)[row].as_py(), np.int64))
                yield pa.RecordBatch.from_arrays([ids, pa.array(own.view(np.int64))], names=["id", "shingle"])

    each = texts.mapInArrow(run, "id long, shingle long")
    alone = each.groupBy("shingle").agg(F.count("*").alias("n"), F.min("id").alias("id")).filter("n = 1")
    return alone.groupBy("id").agg(F.count("*").alias("own"))


BAND = ["band", "hash"]
ROUNDS = 2
BLOCK = 1024


def block_links(frame: pa.Table, percent: int) -> pa.Table:
    """Pairs of rows (id, component, own: the set's hashes) of different components whose sets are similar enough."""
    ids, groups = frame.column("id").to_numpy(), frame.column("component").to_numpy()
    sets = [np.frombuffer(s, np.uint64) for s in frame.column("own").to_pylist()]
    sizes = np.array([len(s) for s in sets], np.int64)
    row = np.repeat(np.arange(len(sets)), sizes)
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)  # what one row alone has is in no intersection
    place = np.full(len(values), -1)
    place[shared] = np.arange(len(shared))
    keep = place[column] >= 0
    row, column = row[keep], place[column[keep]]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, len(shared), 2000):
        here = (column >= at) & (column < at + 2000)
        dense = np.zeros((len(sets), min(2000, len(shared) - at)), np.float32)
        dense[row[here], column[here] - at] = 1
        both += dense @ dense.T
    union = sizes[:, None] + sizes[None, :] - both
    u, v = np.nonzero((100 * both >= percent * union) & (groups[:, None] > groups[None, :]))
    return pa.table({"u": pa.array(ids[u], pa.int64()), "v": pa.array(ids[v], pa.int64())})


class _Search:
    """The state of one search: representatives, buckets, links found."""

    def __init__(self, docs: DataFrame, how: MinHash) -> None:
        self.how = how
        self.signed = materialize(signed_documents(docs, how), "signed")
        sets = self.signed.filter("class is not null and doc is not null").select("doc", "key", "class")
        self.classes = materialize(sets.groupBy("class").agg(F.min("doc").alias("rep")), "classes")
        chosen = self.signed.join(self.classes.select(F.col("class").alias("c"), "rep"), (F.col("class") == F.col("c")) & (F.col("doc") == F.col("rep")), "left_semi")
        narrow = chosen.groupBy("doc", "key").agg(F.first("n").alias("n"), F.first("packed").alias("packed"), F.first("bands").alias("bands"))
        self.reps = materialize(narrow.withColumnRenamed("doc", "id"), "reps")
        # An id with several texts is one document: its classes are linked.
        several = sets.groupBy("doc").agg(F.min("class").alias("a"), F.max("class").alias("b")).filter("a <> b").select("doc")
        pooled = sets.join(several, "doc").join(self.classes, "class").filter("doc <> rep").select(F.col("doc").alias("u"), F.col("rep").alias("v"))
        self.links = materialize(pooled.distinct(), "links")

        each = self.reps.select("id", F.posexplode("bands").alias("band", "hash"))
        shared = each.groupBy(*BAND).agg(F.count("*").alias("size")).filter("size > 1")
        members = materialize(each.join(shared, BAND).distinct(), "members")
        central = members.groupBy("id").agg(F.sum("size").alias("weight"))
        self.open = materialize(members.drop("size").join(central, "id"), "open")
        wanted = members.select("id").distinct()
        with_set = docs.select(F.col("doc_id").cast("long").alias("id"), text_key("text").alias("key"), utf8("text").alias("text"))
        wanted = self.reps.select("id", "key").join(wanted, "id", "left_semi")
        texts = with_set.join(wanted.withColumnsRenamed({"id": "i", "key": "k"}), (F.col("id") == F.col("i")) & (F.col("key") == F.col("k")), "left_semi")
        # Rows that repeat within a task go here; a few may stay, which costs time only.
        self.texts = materialize(texts.dropDuplicates(["id", "key"]).select("id", "text"), "texts")

    def hopeful(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes and estimate leave hope."""
        how = self.how
        u = self.reps.select(F.col("id").alias("u"), F.col("n").alias("n_u"), F.col("packed").alias("packed_u"))
        v = self.reps.select(F.col("id").alias("v"), F.col("n").alias("n_v"), F.col("packed").alias("packed_v"))
        sizes = 100 * F.least("n_u", "n_v") >= how.percent * F.greatest("n_u", "n_v")
        estimate = similarity_estimate(F.col("packed_u"), F.col("packed_v"), how)
        return pairs.join(u, "u").join(v, "v").filter(sizes & (estimate >= how.percent / 100 - how.margin)).select("u", "v").distinct()

    def add_links(self, pairs: DataFrame) -> None:
        pairs = materialize(self.hopeful(pairs), "pairs")
        new = confirmed(pairs, self.texts, self.how)
        self.links = materialize(self.links.union(new), "links")
        self.component = components(self.links)

    def with_component(self, rows: DataFrame) -> DataFrame:
        known = self.component.withColumnsRenamed({"id": "i"})
        return rows.drop("component").join(known, F.col("id") == F.col("i"), "left").drop("i").withColumn("component", F.coalesce("component", "id"))

    def meet_pivots(self) -> None:
        """Every member meets its bucket's pivot, which then leaves the bucket; closed buckets go."""
        pivots = self.open.groupBy(*BAND).agg(F.max(F.struct("weight", (-F.col("id")).alias("minus"))).alias("best"))
        pivots = pivots.select(*BAND, (-F.col("best.minus")).alias("pivot"))
        known = "component" in self.open.columns
        if known:  # joined to the pivots, a row per bucket, as a pivot's members may be very many
            theirs = self.component.select(F.col("id").alias("p"), F.col("component").alias("c"))
            pivots = pivots.join(theirs, F.col("pivot") == F.col("p"), "left").select(*BAND, "pivot", F.coalesce("c", "pivot").alias("theirs"))
        met = materialize(self.open.join(pivots, BAND), "met").filter("id <> pivot")
        fresh = met.filter("component <> theirs") if known else met
        self.add_links(fresh.select(F.col("id").alias("u"), F.col("pivot").alias("v")).distinct())
        self.close(self.with_component(met.drop("pivot", "theirs")))

    def close(self, members: DataFrame) -> None:
        members = materialize(members, "members")
        several = members.groupBy(*BAND).agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b")
        self.open = materialize(members.join(several.select(*BAND), BAND, "left_semi"), "open")

    def drop_hopeless(self) -> None:
        """Members leave a bucket in which no other component has a size that their shared shingles could match."""
        how, step = self.how, 1.05
        ids = self.open.select("id").distinct()
        own = own_shingles(self.texts.join(ids, "id", "left_semi"), how)
        sizes = self.reps.groupBy("id").agg(F.max("n").alias("n"), F.min("n").alias("least"))
        facts = materialize(sizes.join(ids, "id", "left_semi").join(own, "id", "left").select(
            "id", "n", F.when(F.col("n") == F.col("least"), F.col("n") - F.coalesce("own", F.lit(0))).otherwise(F.col("n")).alias("common"),
            F.floor(F.log(F.col("n").cast("double")) / float(np.log(step))).cast("int").alias("level")), "facts")
        here = materialize(self.open.join(facts, "id"), "here")
        there = here.groupBy(*BAND, F.col("level").alias("at")).agg(F.min("n").alias("s"), F.min("component").alias("a"), F.max("component").alias("b"))
        span = int(np.log(100 / how.percent) / np.log(step)) + 2
        asked = here.withColumn("at", F.explode(F.sequence(F.col("level") - span, F.col("level") + span)))
        union = F.col("n") + F.greatest("s", "common") - F.col("common")
        chance = (100 * F.col("common") >= how.percent * union) & ((F.col("a") != F.col("component")) | (F.col("b") != F.col("component")))
        left = asked.join(there, [*BAND, "at"]).filter(chance)
        weight = (F.col("common") * 1_000_000 / F.col("n")).cast("long")
        self.close(left.select(*BAND, "id", weight.alias("weight"), "component").distinct())

    def rest(self) -> None:
        """Members of different components that are still in a bucket together, compared exactly, block by block.

        A task gets the sets of at most two blocks of a bucket and returns links only, so no pairs are spelled out.
        """
        how = self.how
        sizes = self.open.groupBy(*BAND).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        placed = self.open.join(sizes, BAND).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        placed = placed.select(*BAND, "id", "component", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"))

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = [shingles(t, how.shingle).tobytes() for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], names=["i", "own"])

        wanted = self.texts.join(self.open.select("id").distinct(), "id", "left_semi").select("id", "text")
        each = materialize(wanted.mapInArrow(sets, "i long, own binary"), "sets")
        rows = placed.join(each, F.col("id") == F.col("i")).select(*BAND, "one", "two", "id", "component", "own")
        new = rows.groupBy(*BAND, "one", "two").applyInArrow(lambda frame: block_links(frame, how.percent), "u long, v long")
        self.links = materialize(self.links.union(new).distinct(), "links")
        self.component = components(self.links)

    def run(self) -> None:
        self.meet_pivots()
        for k in range(ROUNDS):
            if self.open.isEmpty():
                return
            if k == 0:
                self.drop_hopeless()
            if self.open.isEmpty():
                return
            self.meet_pivots()
        if not self.open.isEmpty():
            self.rest()


def groups(docs: DataFrame, how: MinHash = MinHash()) -> DataFrame:
    """A row for every row of `docs`: doc_id, n_shingles, component_id, kept.

    Null or blank texts have an empty set and are linked with nothing.  Rows with a null doc_id look for no links: one has the
    component of the documents with the same set, if there are any, and is then not kept; else it has none and is kept.  Rows that
    share a doc_id are one document, whose links are pooled.  Other columns take no part.  A very long text is read whole, in memory
    in proportion to it.  No rows give none.
    """
    search = _Search(docs, how)
    search.run()
    named = search.classes.join(search.component, search.classes.rep == search.component.id, "left")
    named = named.select(F.col("class").alias("c"), F.coalesce("component", "rep").alias("component_id"))
    rows = search.signed.join(named, F.col("class") == F.col("c"), "left")
    component = F.coalesce("component_id", "doc")
    return rows.select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc").eqNullSafe(component).alias("kept"), F.col("key").alias("text_key"))


def _keys(docs: DataFrame) -> DataFrame:
    """`docs` with `__doc`: the id, or for a null one 62 bits of the text, above all ids (below, if ids are that large), so that
    of a group the rows with ids are the smaller; null where there is neither an id nor a word."""
    bits = F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1))
    most = docs.agg(F.max(F.col("doc_id").cast("long")).alias("most")).first()["most"]
    key = bits + F.lit(1 << 62 if most is None or most < 1 << 62 else -(1 << 63)).cast("long")
    has_words = F.coalesce(F.col("text").rlike(r"[^ \t-\r]"), F.lit(False))
    return docs.withColumn("__doc", F.when(F.col("doc_id").isNotNull(), F.col("doc_id").cast("long")).when(has_words, key))


def without_copies(docs: DataFrame, how: MinHash = MinHash()) -> DataFrame:
    """`docs` with its columns: of every group one document stays, the one with the smallest id, and one row of it.

    Rows with a null doc_id are grouped like others, each text as a document of its own; those without words all stay.
    """
    keyed = _keys(docs)
    kept = groups(keyed.select(F.col("__doc").alias("doc_id"), "text"), how).filter("kept and doc_id is not null")
    kept = materialize(kept.select(F.col("doc_id").alias("__kept")).distinct(), "kept")
    one = keyed.filter("__doc is not null").join(kept, F.col("__doc") == F.col("__kept"), "left_semi")
    one = one.dropDuplicates(["__doc"])
    return one.unionByName(keyed.filter("__doc is null")).select(*docs.columns)
