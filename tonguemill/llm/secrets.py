"""Secret scans: patterns, and a battery of randomness tests on long tokens with false-discovery control by length.

A token that no pattern knows is a secret if it looks drawn at random from its alphabet.  The alphabet is inferred; three
tests of randomness are made (chi-squared uniformity, runs about the middle, serial correlation) and combined by
Fisher's method into one p-value, uniform for random tokens and near 0 for prose, paths and names.  How small a p-value
may be is decided per alphabet and length over all documents: the random tokens of such a stratum are estimated from the upper
half of the p-values, and the lowest cut is taken at which the tokens beyond their expected number are at most `rate`.

Only DataFrame functions are used; the texts are scanned in place, and only counts per stratum are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns of the base kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run is maximal, so asking for its least length in the pattern drops the same matches as asking afterwards.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LEAST = 12

TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Encodings in the order in which they are tried: name, its pattern, its alphabet.
ENCODINGS = (
    ("decimal", "^[0-9]+$", DIGITS),
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("HEX", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("alnum", "^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    ("base64", "^[0-9A-Za-z+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", "^[0-9A-Za-z_-]+$", UPPER + LOWER + DIGITS + "-_"),
    ("mixed", "", UPPER + LOWER + DIGITS + "+/-_"),
)
BINS = 20
RATE = 0.1

SPAN = "array<struct<start:long,end:long,found:string>>"


def _bind(value: Column, use) -> Column:
    """`use(value)` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _blocks(items: Column) -> Column:
    """An array cut into about sqrt(n) arrays.  A list that grows one by one is copied each time; within blocks it stays short."""
    size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(items).cast("double"))).cast("int"))
    return _bind(size, lambda b: F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(items) - 1), b), lambda i: F.slice(items, i + 1, b)))


def _running(lengths: Column) -> Column:
    """0 and the running sums of an array of about sqrt(n) numbers."""
    start = F.array(F.lit(0).cast("long"))
    return F.aggregate(lengths, start, lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x)))


def _matches(text: Column, pattern: str) -> Column:
    """Leftmost matches in order, as start and end in code points and the match itself.

    What lies between matches and the matches are read in turn, which gives the places: block by block, so that the work grows
    with n times sqrt(n) of the matches and not with their square.
    """
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    length = lambda p: F.length(p["gap"]).cast("long") + F.coalesce(F.length(p["found"]), F.lit(0))

    def step(s: Column, p: Column) -> Column:
        start, end = s["at"] + F.length(p["gap"]), s["at"] + length(p)
        one = F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"), p["found"].alias("found"))
        return F.struct(end.cast("long").alias("at"), F.when(p["found"].isNull(), s["out"]).otherwise(F.concat(s["out"], F.array(one))).alias("out"))

    def placed(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda a, p: a + length(p)))
        begin = lambda at: F.struct(at.alias("at"), F.array().cast(SPAN).alias("out"))
        return _bind(_running(sums), lambda starts: F.flatten(F.transform(blocks, lambda b, i: F.aggregate(b, begin(F.get(starts, i)), step, lambda s: s["out"]))))

    return F.when(F.rlike(text, F.lit(pattern)), _bind(pieces, lambda p: _bind(_blocks(p), placed))).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> dict[str, Column]:
    assigned = F.filter(_matches(text, ASSIGN), lambda m: F.length(F.regexp_extract(m["found"], ASSIGN, 2)) >= ASSIGN_LEAST)
    return {"assign": assigned, "access": _matches(text, ACCESS), "hex": _matches(text, HEX)}


# --- the battery ---------------------------------------------------------------------------------------------------


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a normal Z by a logistic fit (error below 0.0002), kept above 1e-15."""
    x = F.least(F.lit(6.0), F.greatest(F.lit(-6.0), z))
    return F.greatest(F.lit(1e-15), 1 / (1 + F.exp(1.5976 * x + 0.07056 * x**3)))


def _p_value(symbols: Column, size: Column) -> Column:
    """Fisher's combination of the three tests for a token given as places in an alphabet of `size`."""
    n = F.size(symbols).cast("double")
    counts = F.aggregate(
        F.sort_array(symbols),
        F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("squares")),
        lambda s, v: _bind(F.when(v == s["last"], s["run"] + 1).otherwise(F.lit(1.0)),
                           lambda run: F.struct(v.alias("last"), run.alias("run"), (s["squares"] + 2 * run - 1).alias("squares"))),
        lambda s: s["squares"],
    )
    chi = (size / n * counts - n - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)
    middle, mean, variance = size / 2, (size - 1) / 2, (size * size - 1) / 12
    walk = F.aggregate(
        symbols,
        F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("runs"), F.lit(0.0).alias("high"), F.lit(0.0).alias("serial")),
        lambda s, v: F.struct(
            v.alias("last"),
            (s["runs"] + F.when((s["last"] < 0) | ((s["last"] >= middle) != (v >= middle)), 1.0).otherwise(0.0)).alias("runs"),
            (s["high"] + F.when(v >= middle, 1.0).otherwise(0.0)).alias("high"),
            (s["serial"] + F.when(s["last"] < 0, 0.0).otherwise((s["last"] - mean) * (v - mean))).alias("serial"),
        ),
    )

    def combine(w: Column) -> Column:
        both = 2 * w["high"] * (n - w["high"])
        spread = both * (both - n) / (n * n * (n - 1))
        runs_z = F.when(spread > 0, F.abs(w["runs"] - 1 - both / n) / F.sqrt(spread)).otherwise(6.0)
        serial_z = F.abs(w["serial"]) / (variance * F.sqrt(n - 1))
        logs = F.log(_upper_tail(chi)) + F.log(F.least(F.lit(1.0), 2 * _upper_tail(runs_z))) + F.log(F.least(F.lit(1.0), 2 * _upper_tail(serial_z)))
        return _bind(-logs, lambda h: F.exp(-h) * (1 + h + h * h / 2))

    return _bind(walk, combine)


def _tested(token: Column) -> Column:
    """The stratum of a token (encoding and the power of two below its length) and the bin of its p-value."""
    encoding = F.lit(len(ENCODINGS) - 1)
    for k, (_, pattern, _) in reversed(list(enumerate(ENCODINGS[:-1]))):
        encoding = F.when(F.rlike(token, F.lit(pattern)), k).otherwise(encoding)
    alphabets = F.array(*[F.create_map(*[x for i, c in enumerate(alphabet) for x in (F.lit(c), F.lit(i))]) for _, _, alphabet in ENCODINGS])
    sizes = F.array(*[F.lit(float(len(alphabet))) for _, _, alphabet in ENCODINGS])
    names = F.array(*[F.lit(name) for name, _, _ in ENCODINGS])

    def test(e: Column) -> Column:
        letters = F.filter(F.split(token, ""), lambda c: c != "")
        p = _bind(F.transform(letters, lambda c: alphabets[e][c]), lambda symbols: _p_value(symbols, sizes[e]))
        stratum = F.concat_ws(":", names[e], F.floor(F.log2(F.length(token).cast("double"))).cast("string"))
        return F.struct(stratum.alias("stratum"), F.least(F.lit(BINS - 1), F.floor(p * BINS).cast("int")).alias("bin"))

    return _bind(encoding, test)


def _tokens(text: Column) -> Column:
    return F.transform(_matches(text, TOKEN), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), _tested(m["found"]).alias("test")))


def cuts(docs: DataFrame, rate: float = RATE) -> dict[str, int]:
    """The lowest p-value bin that counts as random, per stratum, over all documents.

    What reaches the driver is one number per stratum: at most eight encodings times the powers of two of a length.
    """
    tests = docs.select(F.explode(_tokens(F.coalesce("text", F.lit(""))).getField("test")).alias("t")).select("t.*")
    tests = tests.groupBy("stratum", "bin").count()
    bins = tests.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("bin", "count"))).alias("n"))
    bins = bins.select("stratum", F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.coalesce(F.col("n")[b], F.lit(0))).alias("n"))
    number = lambda low: F.aggregate(F.slice("n", low + 1, BINS), F.lit(0).cast("long"), lambda a, x: a + x)
    random = F.least(number(F.lit(0)), 2 * number(F.lit(BINS // 2)))
    fits = lambda low: (number(low) > 0) & (number(low) - F.col("random") * (BINS - low) / BINS <= rate * number(low))
    bins = bins.withColumn("random", random)
    cut = F.array_min(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), fits))
    return {r["stratum"]: r["cut"] for r in bins.select("stratum", cut.alias("cut")).filter("cut is not null").collect()}


def secret_spans(text: Column, cut: dict[str, int]) -> Column:
    """All spans of a text by start and then kind: struct of start, order, kind and end.

    A random token that overlaps a base span is that span's and adds none.
    """
    text = F.coalesce(text, F.lit(""))
    base = base_spans(text)
    as_kind = lambda spans, k: F.transform(spans, lambda m: F.struct(
        m["start"].alias("start"), F.lit(k).alias("order"), F.lit(KINDS[k]).alias("kind"), m["end"].alias("end")))
    known = F.array_sort(F.concat(*[as_kind(base[kind], k) for k, kind in enumerate(KINDS[:3])]))
    if not cut:
        return known
    lowest = F.create_map(*[F.lit(x) for pair in sorted(cut.items()) for x in pair])
    random = F.filter(_tokens(text), lambda m: m["test"]["bin"] >= F.coalesce(lowest[m["test"]["stratum"]], F.lit(BINS)))

    def with_random(known: Column) -> Column:
        """Blocks of known spans are passed over whole where a token lies outside of them."""
        parts = F.transform(_blocks(known), lambda b: F.struct(
            F.array_min(F.transform(b, lambda k: k["start"])).alias("low"), F.array_max(F.transform(b, lambda k: k["end"])).alias("high"), b.alias("spans")))

        def clear(blocks: Column) -> Column:
            meets = lambda m, low, high: (low < m["end"]) & (m["start"] < high)
            taken = lambda m: F.exists(blocks, lambda b: F.coalesce(meets(m, b["low"], b["high"]), F.lit(False))
                                       & F.exists(b["spans"], lambda k: meets(m, k["start"], k["end"])))
            return F.array_sort(F.concat(known, as_kind(F.filter(random, lambda m: ~taken(m)), 3)))

        return _bind(parts, clear)

    return _bind(known, with_random)


def spelled(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """One row per row of `docs`: doc_id, the numbers and digest of base spans, and all spans.

    A null text is an empty one; rows that repeat, ties and null ids are rows like others, and other columns take no part.  A very
    long text is scanned whole, by work that grows with n times sqrt(n) of its matches.  No rows give none.
    """
    found = docs.select("doc_id", secret_spans(F.col("text"), cuts(docs, rate)).alias("all"))
    count = lambda kind: F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("all", lambda s: s["order"] < 3)
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]], F.sha2(spelled(base), 256).alias("base_sha256"),
        spelled(F.col("all")).alias("spans"), count("random").alias("n_random"),
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every stretch that spans cover replaced by the mark; spans are in order of start.

    A block of spans works on its own stretch of the text, from where the spans before it end.
    """
    part = lambda source, a, b: F.substring(source, (a + 1).cast("int"), F.greatest(F.lit(0), b - a).cast("int"))

    def masked(block: Column, first: Column, last: Column) -> Column:
        """The text from `first` to `last`, the ends of all spans before the block and of the block's own."""

        def within(mine: Column) -> Column:
            start = F.struct(first.alias("at"), F.array().cast("array<string>").alias("out"))

            def step(s: Column, p: Column) -> Column:
                gap = F.when(p["start"] < s["at"], F.array().cast("array<string>")).otherwise(
                    F.array(part(mine, s["at"] - first, p["start"] - first), F.lit(mark)))
                return F.struct(F.greatest(s["at"], p["end"]).alias("at"), F.concat(s["out"], gap).alias("out"))

            return F.aggregate(block, start, step, lambda s: F.array_join(s["out"], ""))

        return _bind(part(text, first, last), within)

    def joined(blocks: Column) -> Column:
        ends = F.transform(blocks, lambda b: F.array_max(F.transform(b, lambda p: p["end"])))
        reach = F.aggregate(ends, F.array(F.lit(0).cast("long")), lambda s, e: F.concat(s, F.array(F.greatest(F.element_at(s, -1), e))))

        def assemble(reach: Column) -> Column:
            rest = F.substring(text, (F.element_at(reach, -1) + 1).cast("int"), F.lit(2**31 - 1))
            return F.concat(F.array_join(F.transform(blocks, lambda b, i: masked(b, F.get(reach, i), F.get(reach, i + 1))), ""), rest)

        return _bind(reach, assemble)

    return F.when(F.size(spans) == 0, text).otherwise(_bind(_blocks(spans), joined))


def without_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """`docs` with its columns; secrets in the text are masked and n_chars, where there is one, follows."""
    name = "__secret_spans"
    masked = docs.withColumn(name, secret_spans(F.col("text"), cuts(docs, rate)))
    changed = F.size(name) > 0
    masked = masked.withColumn("text", redacted(F.col("text"), F.col(name)))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        masked = masked.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return masked.select(*docs.columns)
