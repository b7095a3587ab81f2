"""Operator 9 (native): line dedup by a segment-partition edit join.

DataFrame functions only. A line goes if the same line, or one within `edits`
edits, stands earlier in the corpus (by doc_id, then place). Distinct lines are
cut into edits + 1 segments; of two lines within that distance one has a segment
of the other, at a place that the lengths bound, so index keys (length, segment
number, segment) are probed with the few substrings of lines up to `edits` longer
that can match (multi-match-aware selection). Candidates are verified by banded
bit-parallel edit distance: for each number of errors a word of 2 * edits + 1
bits says which diagonals of the band are alive.

Only whether an earlier line is near matters, not which. So the lines of a key are
first compared with the earliest one that they can meet there, one pair a line and
key; a family of near lines is settled by that. Lines that stay open are then
paired with all earlier lines of their keys, but for pairs whose letters differ in
more places than the edits can change. No pair that could be near is left out.

Equal lines are pre-aggregated before anything is joined, so a line in a third of
all documents is one row of the join. Shorter lines than `least_chars` have no
near ones and take part in that aggregation alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import Table, release

EDITS = 2
#: Shorter lines have no near ones: a few edits make any of them any other. Their exact repeats go, unless they are blank.
LEAST_CHARS = 20
#: Bits of a line's number in its text.
PLACE_BITS = 31


def _segment(length: Column, i: int, edits: int) -> tuple[Column, Column]:
    """Start (from 1) and length of segment i (from 1) of a line: shorter ones first."""
    parts = edits + 1
    base, long = F.floor(length / parts).cast("int"), (length % parts).cast("int")
    short = F.lit(parts) - long
    return base * (i - 1) + F.greatest(F.lit(0), F.lit(i - 1) - short) + 1, base + F.when(F.lit(i) > short, 1).otherwise(0)


def _key(length: Column, i: int, text: Column) -> Column:
    return F.xxhash64(length, F.lit(i), text)


def line_keys(line: Column, n: Column, edits: int = EDITS) -> Column:
    """The index keys of a line (the first edits + 1), then its other probe keys.

    Probe keys are, for each shorter length and segment, the substrings whose shift
    leaves enough errors for either side; the unshifted ones of the line's own
    length are its index keys.
    """
    own, probes = [], []
    for less in range(edits + 1):
        short = (n - less).cast("int")
        for i in range(1, edits + 2):
            at, size = _segment(short, i, edits)
            low, high = max(-(i - 1), less - (edits + 1 - i)), min(i - 1, less + (edits + 1 - i))
            for shift in range(low, high + 1):
                key = _key(short, i, F.substring(line, at + shift, size))
                (own if less == shift == 0 else probes).append(key)
    return F.array(*own, *probes)


def _let(value: Column, body) -> Column:
    """`body` of a value that is made once, however often it is used there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def within(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Whether two arrays of characters are within `edits` edits; a is the shorter one.

    Bit d of word e: the part of a read so far meets b's part that is d - edits
    longer with at most e errors.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1
    # b stands in the state, so that it is made once and not at every step
    start = F.struct(F.lit(0).alias("i"), b.alias("b"), *[F.lit(((1 << (e + 1)) - 1) << edits & full).cast("int").alias(f"r{e}") for e in range(edits + 1)])

    def step(s: Column, c: Column) -> Column:
        bits = sum((F.when(F.get(s["b"], s["i"] + (d - edits)) == c, 1 << d).otherwise(0) for d in range(width)), F.lit(0))

        def moved(same: Column) -> Column:
            rows = [s["r0"].bitwiseAND(same)]
            for e in range(1, edits + 1):
                old = s[f"r{e - 1}"]
                swapped = s[f"r{e}"].bitwiseAND(same).bitwiseOR(old)
                skipped = F.shiftright(old, 1)  # a character of a is left out
                added = F.shiftleft(rows[-1], 1).bitwiseAND(F.lit(full))  # a character of b comes in
                rows.append(swapped.bitwiseOR(skipped).bitwiseOR(added))
            return F.struct((s["i"] + 1).alias("i"), s["b"].alias("b"), *[r.alias(f"r{e}") for e, r in enumerate(rows)])

        return _let(bits, moved)

    def end(s: Column) -> Column:
        more = F.size(s["b"]) - s["i"]  # how much longer b is
        return F.when(more.between(-edits, edits), F.call_function("shiftright", s[f"r{edits}"], more + edits) % 2 == 1).otherwise(False)

    return F.aggregate(a, start, step, end)


#: Pieces by which two lines are compared before their characters are.
PIECES = 16


def _equal_pieces(same, lo: int = 0, hi: int = PIECES) -> Column:
    """How many pieces are equal from one end, by bisection; `same(k)` tells whether k are."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi + 1) // 2
    return F.when(same(mid), _equal_pieces(same, mid, hi)).otherwise(_equal_pieces(same, lo, mid - 1))


def _cut(front: bool):
    """What takes from a struct of `a` and `b` the pieces that both have at one end."""

    def end(x: Column, k: Column) -> Column:
        return F.substring(x, F.lit(1), k) if front else F.substring(x, F.length(x) - k + 1, k)

    def rest(x: Column, k: Column) -> Column:
        return F.substring(x, (k + 1) if front else F.lit(1), F.length(x) - k)

    def cut(s: Column) -> Column:
        size = F.floor(F.least(F.length(s["a"]), F.length(s["b"])) / PIECES).cast("int")
        count = _let(size, lambda z: z * _equal_pieces(lambda k: end(s["a"], z * k) == end(s["b"], z * k)))
        return _let(count, lambda k: F.struct(rest(s["a"], k).alias("a"), rest(s["b"], k).alias("b")))

    return cut


def _trimmed(pair: Column) -> Column:
    """A struct of `a` and `b` without what they share at either end, down to a piece; that leaves their distance as it is."""
    return _let(_let(pair, _cut(True)), _cut(False))


def _pieces_found(a: Column, b: Column, edits: int) -> Column:
    """Whether all but `edits` pieces of `a` stand in `b` at most `edits` places off: each edit can spoil one."""
    size = F.greatest(F.ceil(F.length(a) / PIECES).cast("int"), F.lit(1))
    found = F.lit(0)
    for j in range(PIECES):
        at = size * j + 1
        piece, low = F.substring(a, at, size), F.greatest(at - edits, F.lit(1))
        found = found + F.contains(F.substring(b, low, at + size + edits - low), piece).cast("int")
    return found >= PIECES - edits


def near(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Whether two lines are within `edits` edits: pieces first, then what is left between equal ends, character by character."""
    short, long = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    chars = lambda c: F.split(c, "")
    exact = _let(_trimmed(_trimmed(F.struct(short.alias("a"), long.alias("b")))), lambda s: within(chars(s["a"]), chars(s["b"]), edits))
    return F.when(_pieces_found(short, long, edits), exact).otherwise(False)


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


#: Letters whose counts are compared before two lines become a pair; an edit changes the counts by two at most.
LETTERS = "etaonirshdlu"


def _letters(line: Column) -> Column:
    """Counts of the letters, five bits each."""
    low = F.lower(line)
    out = F.lit(0).cast("long")
    for i, c in enumerate(LETTERS):
        out = out.bitwiseOR(F.shiftleft((F.length(low) - F.length(F.replace(low, F.lit(c), F.lit("")))).cast("long").bitwiseAND(F.lit(31)), 5 * i))
    return out


def _letter_distance(a: Column, b: Column) -> Column:
    """At most the sum of the counts' differences: each is taken round a circle of 32."""
    out = F.lit(0).cast("long")
    for i in range(len(LETTERS)):
        gap = F.abs(F.shiftright(a, 5 * i).bitwiseAND(F.lit(31)) - F.shiftright(b, 5 * i).bitwiseAND(F.lit(31)))
        out = out + F.least(gap, F.lit(32) - gap)
    return out


def _settled(pairs: DataFrame, texts: DataFrame, edits: int, name: str) -> Table:
    """`y` of the pairs `x, y` whose texts are near."""
    x, y = texts.select(F.col("id").alias("x"), F.col("line").alias("a")), texts.select(F.col("id").alias("y"), F.col("line").alias("b"))
    return Table(pairs.join(x, "x").join(y, "y").where(near(F.col("a"), F.col("b"), edits)).select(F.col("y").alias("id")).distinct(), name)


def near_earlier(lines: DataFrame, edits: int = EDITS) -> Table:
    """`id` of each distinct line (`id, line, n`) that has another one with a smaller id within `edits` edits."""
    small = lambda t: F.broadcast(t.df) if t.small() else t.df
    keyed = lines.select("id", F.posexplode(line_keys(F.col("line"), F.col("n"), edits)).alias("pos", "key"))
    keyed = keyed.select("key", "id", (F.col("pos") <= edits).alias("own"))
    group = W.partitionBy("key").orderBy("id").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    # an index key can meet all rows of the key, another probe key only index keys
    first = F.first("id").over(group)
    first_own = F.first(F.when(F.col("own"), F.col("id")), ignorenulls=True).over(group)
    last = F.last("id").over(group)
    met = keyed.select("key", "id", "own", F.when(F.col("own"), first).otherwise(first_own).alias("hub"), first_own.isNotNull().alias("some"), (first != last).alias("met"))
    met = Table(met.where("met and some").select("key", "id", "own", "hub"), "met")
    release(lines.sparkSession)
    ids = Table(met.df.select("id").distinct(), "ids")
    # few lines share a key with another: only their texts travel
    texts = Table(lines.join(small(ids), "id").select("id", "line", _letters(F.col("line")).alias("bag")), "texts")
    release(lines.sparkSession)
    hubs = met.df.where("hub < id").select(F.col("hub").alias("x"), F.col("id").alias("y")).distinct()
    gone = _settled(hubs, texts.df, edits, "settled")

    rest = met.df.join(small(gone), "id", "left_anti").where("hub < id")
    bags = texts.df.select("id", "bag")
    late = rest.join(bags, "id").select("key", F.col("id").alias("y"), F.col("own").alias("oy"), F.col("hub"), F.col("bag").alias("by"))
    early = met.df.join(bags, "id").select("key", F.col("id").alias("x"), F.col("own").alias("ox"), F.col("bag").alias("bx"))
    other = (F.col("x") < F.col("y")) & (F.col("ox") | F.col("oy")) & (F.col("x") != F.col("hub"))
    pairs = late.join(early, "key").where(other & (_letter_distance(F.col("bx"), F.col("by")) <= 2 * edits)).select("x", "y").distinct()
    more = _settled(pairs, texts.df, edits, "settled")
    out = Table(gone.df.union(more.df), "near")
    for t in (met, ids, texts, gone, more):
        t.drop()
    return out


def dedup(docs: DataFrame, edits: int = EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The input's columns with the removed lines cut from `text`, and `n_lines, n_removed bigint`.

    Lines under `least_chars` characters are in no near pair; they go if the same
    line stands earlier, unless they are blank. A null text stays null with no line,
    an empty one has one empty line; an empty table gives one. Null ids come before
    all others; rows that are equal in id and text are one document and get the
    same result; rows of one id with different texts follow each other in a fixed
    order (33 bits of the texts' hashes tell them apart). Texts of any length are
    cut into lines whole, and lines of any length are compared whole.
    """
    spark = docs.sparkSession

    def compared(line: Column) -> Column:
        return (F.length(line) >= least_chars) | line.rlike(r"\S")

    def rest(lines: Column) -> Column:
        """What stays of a text's lines: those at kept places, and those that were not compared."""
        outside = F.filter(F.transform(lines, lambda x, i: F.when(~compared(x), i)), lambda i: i.isNotNull())
        stay = F.array_sort(F.array_union(outside, F.coalesce("__kept", F.array().cast("array<int>"))))
        return _let(stay, lambda at: F.struct(F.array_join(F.transform(at, lambda i: F.get(lines, i)), "\n").alias("text"), F.size(lines).cast("long").alias("n"), F.size(at).cast("long").alias("left")))

    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    base = docs.select(*names).withColumn("__tag", F.shiftright(F.xxhash64("text"), PLACE_BITS))
    place = base.select("doc_id", "__tag", F.posexplode(split_lines(F.col("text"))).alias("p", "line")).where(compared(F.col("line")))
    # a place is a text's tag and the line's number
    ident = F.struct(F.col("doc_id").cast("long").alias("doc"), F.shiftleft("__tag", PLACE_BITS).bitwiseOR(F.col("p").cast("long")).alias("at"))
    distinct = place.groupBy("line").agg(F.min(ident).alias("id")).withColumn("n", F.length("line"))
    lines = Table(distinct, "lines")
    release(spark)
    gone = near_earlier(lines.df.where(F.col("n") >= least_chars), edits)
    release(spark)
    kept = lines.df.select("id").join(F.broadcast(gone.df) if gone.small() else gone.df, "id", "left_anti")
    of, p = F.shiftright("id.at", PLACE_BITS), F.col("id.at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")
    kept = Table(kept.groupBy(F.col("id.doc").alias("__doc"), of.alias("__of")).agg(F.collect_set(p).alias("__kept")), "kept").df
    lines.drop()
    gone.drop()
    release(spark)
    out = base.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")) & (F.col("__tag") == F.col("__of")), "left")
    # one struct a row behind a generator: filters on what it holds would make it again below
    cut = F.when(F.col("text").isNull(), F.struct(F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("left"))).otherwise(_let(split_lines(F.col("text")), rest))
    made = out.select(*[c for c in names if c != "text"], F.explode(F.array(cut)).alias("__r"))
    return made.select(*[F.col("__r.text").alias("text") if c == "text" else F.col(c) for c in names], F.col("__r.n").alias("n_lines"), (F.col("__r.n") - F.col("__r.left")).alias("n_removed"))
