"""Mixing sources to target weights: blocks drawn by a multivariate-hypergeometric splitting tree.

Every source is cut into at most `blocks` disjoint blocks of documents (by a hash of the row, so no task ever sorts a
source).  A source's blocks are put in a random order; its quota are the block draws that its target asks for: whole passes over
that order and then as much of one more as is needed, the last block in part.  A splitting tree decides how many of each
source's draws every output shard gets: a node halves its shards, and the number of draws of every source that go left follows
the multivariate hypergeometric distribution, so the shards are a uniform random partition of all draws.  A shard's share of a
source is then a stretch of that source's draws in permuted order: shards draw disjoint blocks, and what a document gives to the
mix is the sum over the shards that draw its block.

A multivariate draw goes through the sources one by one.  It is made in two steps, over groups of about sqrt(n) of n sources and
within each group, so that no row holds all sources.  Only DataFrame functions are used; texts are read once and not shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonguemill.session import materialize

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mixing:
    """weights: dealt to the sources in order, again and again.  cap: the mix takes no source more than so many times.

    blocks: the most blocks of a source; shards: output shards, a power of two.
    """

    weights: tuple[int, ...] = (1, 2, 3)
    cap: int = 3
    blocks: int = 256
    shards: int = 64
    seed: int = 20

    def __post_init__(self) -> None:
        if self.shards < 1 or self.shards & (self.shards - 1):
            raise ValueError("shards must be a power of two")


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


# --- sources and targets -------------------------------------------------------------------------------------------


def targets(sized: DataFrame, rule: Mixing) -> DataFrame:
    """One row per source: rank, source_size, n_docs, target.

    All rows here are sources.  Targets are the weights' shares of all words, cut at `cap` times the source and reshared:
    that is min(cap * size, level * weight) for one level, found where the sources are ordered by cap * size / weight.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    by_ratio = Window.orderBy("ratio", "rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in rule.weights]), ((F.col("rank") - 1) % len(rule.weights) + 1).cast("int"))
    sources = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
        .withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * rule.cap)
        .withColumn("ratio", F.col("most") / F.col("weight"))
    )
    levelled = (
        sources.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("below", F.sum("most").over(by_ratio) - F.col("most"))
        .withColumn("open", F.sum("weight").over(everything) - F.sum("weight").over(by_ratio) + F.col("weight"))
        .withColumn("level", (F.col("total") - F.col("below")) / F.col("open"))
        .withColumn("fits", F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level")))
        .withColumn("level", F.coalesce(F.min("fits").over(everything)["level"], F.lit(0.0)))
    )
    target = F.least(F.col("most").cast("double"), F.col("level") * F.col("weight"))
    return levelled.select("source", "rank", "source_size", "n_docs", target.alias("target"))


# --- the splitting tree --------------------------------------------------------------------------------------------


def _log_factorial(n: Column) -> Column:
    """ln n!: listed for small n, else Stirling's series, whose error there is below 1e-13."""
    small = F.array(*[F.lit(math.lgamma(k + 1)) for k in range(20)])
    x = n.cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return F.when(n < 20, F.element_at(small, (n + 1).cast("int"))).otherwise(series)


def _bind(value: Column, use) -> Column:
    """`use(value)` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def hypergeometric(u: Column, population: Column, marked: Column, drawn: Column) -> Column:
    """How many of the `drawn` are marked: the distribution's values are tried from the mode outwards until `u` is used up.

    The steps cover twelve standard deviations, beyond which less is left than a double can tell from nothing.
    """
    low = F.greatest(F.lit(0).cast("long"), drawn - (population - marked))
    high = F.least(drawn, marked)
    mode = F.least(high, F.greatest(low, F.floor((drawn + 1) * (marked + 1) / (population + 2)).cast("long")))
    choose = lambda a, b: _log_factorial(a) - _log_factorial(b) - _log_factorial(a - b)
    log_p = choose(marked, mode) + choose(population - marked, drawn - mode) - choose(population, drawn)
    share = marked / F.greatest(population, F.lit(1))
    steps = F.least(high - low, F.ceil(12 * F.sqrt(drawn * share * (1 - share))).cast("long") + 30)

    def start(p: Column) -> Column:
        found = F.when(u < p, mode)
        return F.struct(mode.alias("up"), p.alias("p_up"), mode.alias("down"), p.alias("p_down"), (u - p).alias("left"), found.alias("found"))

    def step(s: Column, _: Column) -> Column:
        up, down = s["up"] + 1, s["down"] - 1
        p_up = F.when(up > high, 0.0).otherwise(
            s["p_up"] * (marked - s["up"]) * (drawn - s["up"]) / (up * (population - marked - drawn + up)))
        p_down = F.when(down < low, 0.0).otherwise(
            s["p_down"] * s["down"] * (population - marked - drawn + s["down"]) / ((marked - down) * (drawn - down)))
        found = F.coalesce(s["found"], F.when(s["left"] < p_up, up).when(s["left"] < p_up + p_down, down))
        return F.struct(up.alias("up"), p_up.alias("p_up"), down.alias("down"), p_down.alias("p_down"),
                        (s["left"] - p_up - p_down).alias("left"), found.alias("found"))

    walk = lambda p: F.aggregate(F.sequence(F.lit(0).cast("long"), steps), start(p), step, lambda s: F.coalesce(s["found"], mode))
    return _bind(F.exp(log_p), walk)


def _go_left(quotas: Column, left: Column, rule: Mixing, *place: Column) -> Column:
    """How many of each quota go left, one by one from what is left of `left`; `place` tells this draw from others."""
    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, q: a + q)
    start = F.struct(total.alias("all"), left.alias("drawn"), F.array().cast("array<long>").alias("out"))

    def step(s: Column, q: Column) -> Column:
        x = hypergeometric(_uniform(F.lit(rule.seed), *place, F.size(s["out"])), s["all"], q, s["drawn"])
        return _bind(x, lambda x: F.struct((s["all"] - q).alias("all"), (s["drawn"] - x).alias("drawn"),
                                           F.concat(s["out"], F.array(x)).alias("out")))

    return F.aggregate(quotas, start, step, lambda s: s["out"])


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, q: a + q)


def split_quotas(quotas: DataFrame, rule: Mixing) -> DataFrame:
    """From rank and quota of every source: rank, shard and n, the draws of the source that the shard gets.  Shards differ by one draw.

    Sources are dealt into groups of about sqrt(n).  Per node of the tree, one row holds the groups' sums and one row each group's
    quotas: the draw over the sums says how many of each group go left, and the draw within a group which of its sources.
    """
    n = quotas.count()
    size = max(1, math.isqrt(n))
    place = F.struct("rank", "quota")
    groups = quotas.withColumn("group", F.floor((F.col("rank") - 1) / size).cast("long")).groupBy("group")
    groups = groups.agg(F.array_sort(F.collect_list(place)).alias("members"))
    groups = groups.select("group", F.transform("members", lambda m: m["rank"]).alias("ranks"), F.transform("members", lambda m: m["quota"]).alias("quotas"))
    nodes = groups.withColumn("node", F.lit(1).cast("long"))
    for level in range(rule.shards.bit_length() - 1):
        sums = nodes.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("group", _sum(F.col("quotas")).alias("sum")))).alias("sums"))
        all_sums = F.transform("sums", lambda g: g["sum"])
        go = _go_left(all_sums, F.floor(_sum(all_sums) / 2).cast("long"), rule, F.col("node"))
        lefts = sums.select("node", F.explode(F.arrays_zip(F.transform("sums", lambda g: g["group"]).alias("group"), go.alias("left"))).alias("g"))
        nodes = nodes.join(lefts.select("node", "g.group", "g.left"), ["node", "group"])
        inside = _go_left(F.col("quotas"), F.col("left"), rule, F.col("node"), F.col("group"), F.lit(-1))
        nodes = nodes.select("node", "group", "ranks", "quotas", inside.alias("left"))
        halves = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quotas")),
            F.struct((F.col("node") * 2 + 1).alias("node"), F.zip_with("quotas", "left", lambda q, x: q - x).alias("quotas")),
        )
        nodes = nodes.select("group", "ranks", F.inline(halves))
        nodes = materialize(nodes.select("group", "ranks", "quotas", "node"), f"level_{level}")
    each = F.explode(F.arrays_zip(F.col("ranks").alias("rank"), F.col("quotas").alias("n"))).alias("s")
    return nodes.select((F.col("node") - rule.shards).cast("int").alias("shard"), each).select("s.rank", "shard", "s.n")


# --- blocks --------------------------------------------------------------------------------------------------------


def numbered_rows(docs: DataFrame, rule: Mixing, keep: bool = False) -> DataFrame:
    """doc_id, source, size and row of every row of `docs`, written: `row` tells rows apart also where ids are null or repeat.

    It is a hash of id and text, and of a number of its own for rows that share both.  `keep` keeps all columns, as `doc`.
    """
    more = [F.struct(*[docs[c] for c in docs.columns]).alias("doc")] if keep else []
    text = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    rows = docs.select(docs["doc_id"], docs["source"], word_count(docs["text"]).alias("size"), text.alias("text_key"), *more)
    rows = materialize(rows.withColumn("number", F.monotonically_increasing_id()), "rows")
    same = (F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("__id"), F.col("text_key").alias("__key"))
    twice = rows.select(*same).groupBy("__id", "__key").count().filter("count > 1").select("__id", "__key")
    twice = materialize(twice.withColumn("__twice", F.lit(True)), "twice")
    found = (F.coalesce(rows["doc_id"].cast("long"), F.lit(0).cast("long")) == twice["__id"]) & (rows["text_key"] == twice["__key"])
    row = F.xxhash64(F.lit(rule.seed + 1), "doc_id", "text_key", F.when(F.col("__twice"), F.col("number")))
    return rows.join(twice, found, "left").select("doc_id", "source", "size", row.alias("row"), *(["doc"] if keep else []))


def _block(n_docs: Column, rule: Mixing) -> Column:
    """The block of a row among those of its source; a source has no more blocks than rows."""
    return F.pmod(F.col("row"), F.least(F.lit(rule.blocks).cast("long"), n_docs))


def source_blocks(rows: DataFrame, sources: DataFrame, rule: Mixing) -> DataFrame:
    """One row per block: rank, block, its place in the source's permuted order, n_blocks, passes (whole draws) and part (of one more).

    At most `blocks` rows per source, so each window below is bounded.
    """
    placed = rows.join(sources, rows.source.eqNullSafe(sources.source)).select("rank", "source_size", "target", "size", _block(F.col("n_docs"), rule).alias("block"))
    in_source = Window.partitionBy("rank")
    shuffled = in_source.orderBy(F.xxhash64(F.lit(rule.seed + 2), F.col("rank"), F.col("block")), "block")
    passes = F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("long")
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    part = F.when(F.col("block_size") > 0, (rest - F.col("before")) / F.col("block_size")).otherwise(0.0)
    blocks = (
        placed.groupBy("rank", "block")
        .agg(F.sum("size").alias("block_size"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
        .withColumn("place", F.row_number().over(shuffled) - 1)
        .withColumn("n_blocks", F.count("*").over(in_source))
        .withColumn("before", F.sum("block_size").over(shuffled) - F.col("block_size"))
        .withColumn("passes", passes)
        .withColumn("part", F.least(F.lit(1.0), F.greatest(F.lit(0.0), part)))
    )
    # Blocks without words come last of a pass that is not whole, so the draws of a source are a stretch of places.
    drawn = F.row_number().over(in_source.orderBy(F.col("part") == 0, "place")) - 1
    blocks = blocks.withColumn("place", drawn)
    return blocks.select("rank", "block", "place", "n_blocks", "passes", "part")


def draw_blocks(blocks: DataFrame, rule: Mixing) -> DataFrame:
    """One row per block that is drawn, with its draws: shard, pass, and the part of the block that is taken.

    A source's draws are numbered pass by pass in permuted order; the tree gives every shard a number of them, and the shard draws
    the next so many.
    """
    quota = (F.max(F.col("passes") * F.col("n_blocks")) + F.count_if(F.col("part") > 0)).cast("long")
    shards = split_quotas(materialize(blocks.groupBy("rank").agg(quota.alias("quota")), "quotas"), rule)
    up_to = F.sum("n").over(Window.partitionBy("rank").orderBy("shard"))
    shares = shards.withColumn("end", up_to).filter("n > 0")
    draws = shares.select("rank", "shard", F.explode(F.sequence(F.col("end") - F.col("n"), F.col("end") - 1)).alias("draw"))
    sizes = blocks.groupBy("rank").agg(F.first("n_blocks").alias("n_blocks"))
    draws = draws.join(sizes, "rank").select(
        "rank", "shard", F.expr("draw div n_blocks").alias("pass"), F.expr("draw % n_blocks").alias("place"))
    found = draws.join(blocks.drop("n_blocks"), ["rank", "place"])
    part = F.when(F.col("pass") < F.col("passes"), F.lit(1.0)).otherwise(F.col("part"))
    one = F.struct("shard", "pass", part.alias("part"))
    return found.groupBy("rank", "block").agg(F.array_sort(F.collect_list(one)).alias("draws"))  # at most cap + 1 draws of a block


def _mixed(rows: DataFrame, rule: Mixing) -> DataFrame:
    sources = materialize(targets(rows, rule), "targets")
    blocks = materialize(source_blocks(rows, sources, rule), "blocks")
    plan = materialize(draw_blocks(blocks, rule), "plan")
    rows = rows.join(sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
    rows = rows.withColumn("block", _block(F.col("n_docs"), rule)).join(plan, ["rank", "block"], "left")
    luck = _uniform(F.lit(rule.seed + 3), F.col("row"))
    words = lambda d: F.least(F.col("size"), F.floor(d["part"] * F.col("size") + luck).cast("long"))
    draws = F.transform("draws", lambda d: F.struct(d["shard"].alias("shard"), d["pass"].alias("pass"), words(d).alias("words")))
    none = F.array().cast("array<struct<shard:int,pass:long,words:long>>")
    rows = rows.withColumn("draws", F.coalesce(F.filter(draws, lambda d: d["words"] > 0), none))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"])
    return rows.withColumn("taken", taken)


RESULT = ("doc_id", "size", "source_size", "target", "taken", "draws")


def mix(docs: DataFrame, rule: Mixing = Mixing()) -> DataFrame:
    """Every row of `docs`: doc_id, size, source_size, target, taken and `draws`.

    A draw is a shard, a pass and the number of leading words the mix takes there.  Rows that repeat are mixed
    each for itself; ids may be null or repeat; a null source is a source, a null or empty text has size 0 and is never taken
    from; a very long text is a row like others, of which a part may be taken.  Other columns take no part.  No rows give none.
    """
    return _mixed(numbered_rows(docs, rule), rule).select(*RESULT)


def mixed_rows(docs: DataFrame, rule: Mixing = Mixing()) -> DataFrame:
    """The mix itself: a row for every draw of a document, with mix_shard, mix_order and mix_words; columns of the table that have
    these names are replaced.

    A shard's rows in the order of mix_order are shuffled; a reader takes the first mix_words words of each row's text.
    """
    drawn = _mixed(numbered_rows(docs, rule, keep=True), rule).select("doc", "row", F.explode("draws").alias("draw"))
    order = F.xxhash64(F.lit(rule.seed + 4), F.col("row"), F.col("draw.pass"))
    own = {"mix_shard": F.col("draw.shard"), "mix_order": order, "mix_words": F.col("draw.words")}
    kept = [F.col("doc").getField(c).alias(c) for c in docs.columns if c not in own]
    return drawn.select(*kept, *[column.alias(name) for name, column in own.items()])
