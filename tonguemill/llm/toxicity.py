"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length, with exception phrases.

Texts are folded first: case, accents, letters of other scripts that look Latin, and digits or signs that stand for letters.
The lexicon is learned from labelled rows: words and beginnings of words (so that inflected forms count) that
stand in toxic documents far more often than chance allows, first counted by documents and then by different surroundings, so
that copies of a toxic document do not bring in all of its words; the weight is the smoothed log-odds.  Exceptions are pairs of
words round a lexicon entry that clean documents use.  A document's weights, divided by a power of its length, go
through a logistic curve; power and curve are fitted on the labelled rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonguemill.session import materialize

# --- folding -------------------------------------------------------------------------------------------------------

#: Letters of other scripts and forms that look like Latin letters.
HOMOGLYPHS = dict(zip(
    "абвеѕіјкмнорсстухԁɡһӏαβεικνορτυχοսօեհ",
    "abbesijkmhopcctyxdghlabeiknoptuxosoeh",
))
#: Digits and signs that stand for letters.
SUBSTITUTES = dict(zip("013457@$!|", "oieastasil"))

_SIGNS = re.compile(r"[013457@$!|]{1,2}(?=[a-z])")
_LETTERS = re.compile(r"[^\W\d_]+")
_PLAIN: dict[int, str | None] = {}


class _Fold(dict):
    """Folds a character on first sight: accents go, look-alikes become Latin."""

    def __missing__(self, code: int) -> str | None:
        letter = HOMOGLYPHS.get(chr(code), chr(code))
        parts = unicodedata.normalize("NFKD", letter)
        plain = "".join(HOMOGLYPHS.get(c, c) for c in parts if not unicodedata.combining(c))
        out = None if unicodedata.category(chr(code)) == "Cf" else plain
        if len(self) < 100_000:
            self[code] = out
        return out


_FOLD = _Fold()


def fold(text: str) -> str:
    """The text in lower-case look-alike Latin; `1d10t` and `idiоt` (Cyrillic o) become `idiot`."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(_FOLD)
    return _SIGNS.sub(lambda m: "".join(SUBSTITUTES[c] for c in m.group()), text)


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall(fold(text)) if text else []


# --- learning ------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Learning:
    """stems: lengths of word beginnings that may enter the lexicon.  chance: the expected number of entries that get in by
    chance.  sample: labelled rows on which the curve is fitted.
    """

    stems: tuple[int, ...] = (4, 5, 6)
    chance: float = 0.01
    least: int = 3
    sample: int = 20_000
    powers: tuple[float, ...] = (0.0, 0.15, 0.3, 0.5, 0.75)


@dataclass
class Lexicon:
    """weights: by entry; ` word ` is a whole word and ` stem` a beginning.  exceptions: ` word word ` in which it does not count."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    power: float = 0.0
    slope: float = 1.0
    intercept: float = -2.0

    def matcher(self) -> Matcher:
        return Matcher(self)


class Matcher:
    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon, self.automaton = lexicon, ahocorasick.Automaton()
        for entry in lexicon.weights.keys() | lexicon.exceptions:
            self.automaton.add_word(entry, entry)
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, words: list[str]) -> list[tuple[int, str]]:
        """Place in ` word word ... ` and entry: the longest entry of a word counts, unless an exception covers it."""
        if not len(self.automaton) or not words:
            return []
        found: dict[int, str] = {}
        spared: list[tuple[int, int]] = []
        for last, entry in self.automaton.iter(" " + " ".join(words) + " "):
            start = last + 1 - len(entry)
            if entry in self.lexicon.exceptions:
                spared.append((start, last))
            elif len(entry) > len(found.get(start, "")):
                found[start] = entry
        if spared:
            found = {at: e for at, e in found.items() if not any(a <= at < b for a, b in spared)}
        return sorted(found.items())

    def strength(self, words: list[str]) -> float:
        return sum(self.lexicon.weights[entry] for _, entry in self.hits(words))

    def score(self, text: str | None) -> float:
        words = words_of(text)
        x = self.strength(words) / max(1, len(words)) ** self.lexicon.power
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, self.lexicon.intercept + self.lexicon.slope * x))))


def _features(text: str | None, stems: tuple[int, ...]) -> set[str]:
    words = set(words_of(text))
    return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in stems if len(w) > n}


def _counts(labelled: DataFrame, features, schema: str = "entry string, toxic long, clean long", hold: int = 300_000) -> DataFrame:
    """Documents with a feature, toxic and clean.  Tasks add up what they have seen, `hold` features at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            keys = list(seen[0].keys() | seen[1].keys())
            columns = [pa.array(keys, pa.string()), *[pa.array([c[k] for k in keys], pa.int64()) for c in reversed(seen)]]
            for c in seen:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, names=["entry", "toxic", "clean"])

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                seen[toxic.as_py()].update(features(text.as_py()))
                if len(seen[0]) + len(seen[1]) > hold:
                    yield flush()
        yield flush()

    counts = labelled.select("text", "toxic").mapInArrow(run, schema)
    return counts.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _significant(counts: DataFrame, sizes, base: float, tried: int, how: Learning) -> DataFrame:
    """entry and weight of all that is counted with toxic rows beyond chance: twice the log-likelihood gained over the base rate
    exceeds what the best of so many tried would reach by chance."""
    t, c = F.col("toxic").cast("double"), F.col("clean").cast("double")
    rate = t / (t + c)
    gain = 2 * (t * F.log(rate / base) + F.when(c > 0, c * F.log((1 - rate) / (1 - base))).otherwise(0.0))
    odds = F.log((t + 0.5) / (sizes["toxic"] + 1)) - F.log((c + 0.5) / (sizes["clean"] + 1))
    scored = counts.filter(F.col("toxic") >= how.least).select("entry", gain.alias("gain"), odds.alias("weight"), rate.alias("rate"))
    return scored.filter((F.col("gain") >= 2 * math.log(max(2, tried) / how.chance)) & (F.col("rate") > 0.5)).select("entry", "weight")


#: Bits of the filter by which tasks know candidates, and bits of one row of Spark's bitmaps.
FILTER_BITS, BITMAP_BITS = 1 << 23, 32768


def _filter_of(candidates: DataFrame) -> bytes:
    """A bit for the hash of each candidate: one megabyte, however many there are."""
    slot = F.pmod(F.crc32(F.col("entry").cast("binary")), F.lit(FILTER_BITS))
    rows = candidates.groupBy((slot / BITMAP_BITS).cast("int").alias("part")).agg(F.bitmap_construct_agg(slot % BITMAP_BITS).alias("bits"))
    out = bytearray(FILTER_BITS // 8)
    for r in rows.toLocalIterator():
        at = r["part"] * BITMAP_BITS // 8
        out[at : at + len(r["bits"])] = r["bits"]
    return bytes(out)


def _surroundings(labelled: DataFrame, candidates: DataFrame, stems: tuple[int, ...]) -> DataFrame:
    """entry, toxic and clean for every candidate: the different pairs of neighbours it has in toxic and in clean rows.

    Tasks count what the filter lets through; what is no candidate and has the hash of one goes in the join.
    """
    bits, lengths = _filter_of(candidates), sorted(set(stems))

    def likely(entry: str) -> bool:
        slot = zlib.crc32(entry.encode()) % FILTER_BITS
        return bool(bits[slot >> 3] >> (slot & 7) & 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        for batch in batches:
            found: set[tuple[str, int, int]] = set()
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                words = words_of(text.as_py())
                for i, w in enumerate(words):
                    mine = known.get(w)
                    if mine is None:
                        mine = [e for e in (f" {w} ", *(f" {w[:n]}" for n in lengths if len(w) > n)) if likely(e)]
                        if len(known) < 100_000:
                            known[w] = mine
                    if mine:
                        near = zlib.crc32(" ".join(words[max(0, i - 1) : i] + ["|"] + words[i + 1 : i + 2]).encode())
                        found.update((e, near, toxic) for e in mine)
            columns = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int32()))], names=["entry", "near", "toxic"])

    places = labelled.select("text", "toxic").mapInArrow(run, "entry string, near long, toxic int")
    places = places.groupBy("entry", "near").agg(F.max("toxic").alias("toxic"), (1 - F.min("toxic")).alias("clean"))
    counts = places.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    return counts.join(candidates.select("entry"), "entry", "left_semi")


def learn(labelled: DataFrame, how: Learning = Learning()) -> Lexicon:
    """A lexicon from rows of `text` and `toxic` (0 or 1), and `doc_id` if there is one; without rows of both kinds it is empty.

    All labelled rows are counted.  What reaches the driver is the lexicon, which has every entry and exception that passes, a
    filter of fixed size, and the strengths and lengths of about `sample` rows for the curve.
    """
    # Rows are drawn by their id, or else by their place as written.
    draw = F.xxhash64("doc_id" if "doc_id" in labelled.columns else F.monotonically_increasing_id()).alias("draw")
    labelled = materialize(labelled.select(F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic"), draw), "labelled")
    sizes = labelled.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean")).first()
    if not sizes["toxic"] or not sizes["clean"]:
        return Lexicon(intercept=-2.0 if not sizes["toxic"] else 0.0)
    base = sizes["toxic"] / (sizes["toxic"] + sizes["clean"])
    stems = how.stems
    by_document = materialize(_counts(labelled, lambda text: _features(text, stems)).filter(F.col("toxic") >= how.least), "features")
    tried = by_document.count()
    candidates = _significant(by_document, sizes, base, tried, how)
    by_place = _significant(_surroundings(labelled, candidates, stems), sizes, base, tried, how)
    lexicon = Lexicon({r["entry"]: r["weight"] for r in by_place.collect()})
    if not lexicon.weights:
        lexicon.intercept = math.log(base / (1 - base))
        return lexicon
    matcher_of = lexicon

    def phrases(text: str) -> set[str]:
        words = words_of(text)
        matcher = _cached(matcher_of)
        starts, at = {}, 0
        for i, w in enumerate(words):
            starts[at] = i
            at += len(w) + 1
        out = set()
        for at, _ in matcher.hits(words):
            i = starts[at]
            out |= {f" {' '.join(words[max(0, j) : j + 2])} " for j in (i - 1, i) if j >= 0 and j + 2 <= len(words)}
        return out

    used = _counts(labelled, phrases).filter((F.col("clean") >= how.least) & (F.col("clean") / (F.col("clean") + F.col("toxic")) > 0.9))
    spared = used.select("entry").collect()
    lexicon = Lexicon(lexicon.weights, frozenset(r["entry"] for r in spared))
    return _fit(labelled, lexicon, how)


_MATCHERS: dict[int, Matcher] = {}


def _cached(lexicon: Lexicon) -> Matcher:
    """The matcher of a lexicon, built once per Python worker and lexicon."""
    key = hash((frozenset(lexicon.weights.items()), lexicon.exceptions, lexicon.power, lexicon.slope, lexicon.intercept)) if lexicon.weights else 0
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = lexicon.matcher()
    return _MATCHERS[key]


def _fit(labelled: DataFrame, lexicon: Lexicon, how: Learning) -> Lexicon:
    """Power and logistic curve on about `sample` labelled rows, chosen by `draw`, so that copies of a text are drawn one by one."""

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        for batch in batches:
            words = [words_of(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([matcher.strength(w) for w in words], pa.float64()), pa.array(map(len, words), pa.int64()), batch.column(1)],
                names=["strength", "n", "toxic"])

    share = min(1.0, how.sample / max(1, labelled.count()))
    sample = labelled.filter(F.pmod("draw", F.lit(1_000_000)) < int(share * 1_000_000))
    rows = sample.select("text", "toxic").mapInArrow(strengths, "strength double, n long, toxic int").toPandas()
    y = rows["toxic"].to_numpy(float)
    best = (math.inf, 0.0, -2.0, 1.0)
    for power in how.powers:
        x = rows["strength"].to_numpy() / np.maximum(1, rows["n"].to_numpy()) ** power
        loss, intercept, slope = _logistic(x, y)
        if loss < best[0] - 1e-9:
            best = (loss, power, intercept, slope)
    return Lexicon(lexicon.weights, lexicon.exceptions, best[1], best[3], best[2])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4) -> tuple[float, float, float]:
    """Loss, intercept and slope of a logistic curve by Newton's steps; the slope is not negative."""
    scale = float(x[x > 0].mean()) if (x > 0).any() else 1.0
    design, beta = np.stack([np.ones_like(x), x / scale], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (p - y) / len(y) + ridge * beta
        curve = (design * (p * (1 - p))[:, None]).T @ design / len(y) + ridge * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta = beta - step
        if np.abs(step).max() < 1e-8:
            break
    beta[1] = max(0.0, beta[1])
    p = np.clip(1 / (1 + np.exp(-np.clip(design @ beta, -30, 30))), 1e-12, 1 - 1e-12)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()), float(beta[0]), float(beta[1] / scale)


# --- scoring -------------------------------------------------------------------------------------------------------


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts with a 0/1 label, without held-out rows.  Ids with labels that differ, and null ids, are not learned from."""
    sure = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").alias("id"))
    sure = sure.agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).filter("toxic = other").drop("other")
    learnable = docs.filter(~held_out() & F.col("text").isNotNull()).select("doc_id", "text")
    # Both sides may be large, so the plan is the same at every size: one shuffle of the texts that may be learned from.
    return learnable.hint("merge").join(sure, learnable.doc_id == sure.id).select("doc_id", "text", "toxic")


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """doc_id, score and predicted for every row of `docs`.

    Null and empty texts get the score of no hit.  A row's score depends on its text alone: rows that repeat score alike, ids may be
    null or repeat, other columns take no part, and a score just at the threshold is predicted.  Where entries of a word tie in
    length, each stands for the same beginning.  A very long text is matched whole.  No rows give none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        for batch in batches:
            scores = [matcher.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """`docs` with its columns, without the rows that score at least `threshold`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([matcher.score(t) < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
