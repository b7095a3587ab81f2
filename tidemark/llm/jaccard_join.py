"""Operator 6: n-gram Jaccard join by token-combination prefixes.

Documents are sets of word shingles ("tokens", 64-bit hashes). Equal sets are
one class, and only classes are joined.

Filter. Tokens in hash order: of two sets with Jaccard >= t both have the k
smallest common tokens in their first n - ceil(t n) + k tokens. Prefixes are so
extended (k grows with n), and a class goes on only if that many tokens of its
prefix occur in another class. No table of all tokens is ever shuffled.

Index. For what goes on, tokens are counted and ordered from rare to frequent.
Rare ones are indexed alone; frequent ones as combinations of two that follow
each other in that order. A pair with a tokens of its own on one side and b on
the other shares all but a of the first side's n rare tokens and all but 2 a + b
of its combinations, and a + t b <= (1 - t) n; so prefixes of
floor((1 - t) n) or floor(2 (1 - t) n) and one more elements must meet (op6: t = 85 %).

Verify. In each index bucket classes are paired with the bucket's hub, the class
with the fewest rare tokens, then verified exactly and joined to components. What
remains are pairs of a bucket whose members are in different components; all of
them that the positions and the parity bits allow are verified. Copies of a text in
a group of thousands so need a link each, not a link for each pair.

Parity bits. Each class has a bit for each of `BITS` hash values: whether an odd
number of its tokens has it. Bits in which two classes differ are at most the tokens
that only one of them has, and of these a pair that links has at most
(1 - t) / (1 + t) of both sizes; so no pair that links is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import Table, release
from .shingles import U64, mix, shingle_sets, slices

WORDS = 4
#: Jaccard threshold in hundredths.
PERCENT = 85
#: Parity bits of a class.
BITS = 512
#: Tokens in more classes than this are indexed in combinations.
FREQUENT = 64


def _extra(n: int) -> int:
    """Common tokens looked for in the extended prefix of a set of n; never falls with n."""
    return 1 + n // 12


def _loss(n: int, percent: int) -> int:
    return n * (100 - percent) // 100


def _least_size(percent: int) -> int:
    """Tokens of the smallest set that can link with another one: the nearest it can come is a set of one more."""
    return max(1, -(-percent // max(1, 100 - percent)))


def _sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """`doc_id, n, s1, s2, least, prefix`: size, signature, tokens wanted in other classes, and the extended prefix of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, s1, s2, least, prefix = [], [], [], [], []
            for s in shingle_sets(batch.column(1).to_pylist(), words):
                m = len(s)
                n.append(m)
                s1.append(int(s.sum(dtype=U64).view(np.int64)) if m else 0)
                s2.append(int(mix(s ^ U64(0xD6E8FEB86659FD93)).sum(dtype=U64).view(np.int64)) if m else 0)
                least.append(_extra(-(-m * percent // 100)))  # the smallest partner's
                prefix.append(s[: _loss(m, percent) + _extra(m)].view(np.int64) if m >= _least_size(percent) else s[:0].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(least, pa.int32()), pa.array(prefix, pa.list_(pa.int64()))], ["doc_id", "n", "s1", "s2", "least", "prefix"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, n bigint, s1 bigint, s2 bigint, least int, prefix array<bigint>")


def _tokens(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = list(shingle_sets(batch.column(1).to_pylist(), words))
            odd = [np.packbits(np.bincount((s % U64(BITS)).astype(np.int64), minlength=BITS) & 1).view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array(odd, pa.list_(pa.int64()))], ["rep", "tokens", "odd"])

    return docs.mapInArrow(run, "rep bigint, tokens array<bigint>, odd array<bigint>")


def _differing(x: Column, y: Column) -> Column:
    """Parity bits in which two classes differ."""
    out = F.lit(0)
    for i in range(BITS // 64):
        out = out + F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i))))
    return out


def _signatures(ordered: DataFrame, percent: int, frequent: int) -> DataFrame:
    """`key, rep, n, most, rares`: prefix elements of `rep, n, toks array<struct<df,h>>` (tokens of other classes, rarest first).

    `most` is the overlap still possible if the element is the first shared one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            flat = batch.column(2).flatten()
            df, h = flat.field(0).to_numpy(), flat.field(1).to_numpy().view(U64)
            offs = batch.column(2).offsets.to_numpy() - batch.column(2).offsets[0].as_py()
            out = ([], [], [], [], [])
            for i, (rep, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                d, t = df[offs[i] : offs[i + 1]], h[offs[i] : offs[i + 1]]
                r = int(np.searchsorted(d, frequent, "right"))
                alone = n - len(t)  # tokens that no other class has; they come first
                f_d, f_t = d[r:], t[r:]
                f = len(f_t)
                loss = _loss(n, percent)
                size = min(2 * n * (100 - percent) // 100, loss + max(f - 1, 0)) + 1
                combos, weight = mix(f_t[:-1] * U64(3) ^ mix(f_t[1:])), f_d[:-1] + f_d[1:]
                by = np.lexsort((combos, weight))
                keys = np.concatenate((t[:r], combos[by]))[: max(0, size - alone)]
                before = np.minimum(alone + np.arange(len(keys)), alone + r)  # rare tokens that then are unshared
                ok = before <= loss
                keys = keys[ok]
                out[0].append(keys.view(np.int64))
                out[1].append(np.full(len(keys), rep, np.int64))
                out[2].append(np.full(len(keys), n, np.int64))
                out[3].append(n - before[ok])
                out[4].append(np.full(len(keys), alone + r, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in out], ["key", "rep", "n", "most", "rares"])

    return ordered.select("rep", "n", "toks").mapInArrow(run, "key bigint, rep bigint, n bigint, most bigint, rares bigint")


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs at least twice: the counts are written first, so that Spark may split a hot key of the join."""
    met = Table(rows.groupBy(key).count().where("count > 1").select(key), "met")
    return rows.join(met.df, key)


def _verified(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Of `a, b` the ones with Jaccard >= percent, counted on the whole sets."""
    x = tokens.select(F.col("rep").alias("a"), F.col("tokens").alias("ta"))
    y = tokens.select(F.col("rep").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", both.alias("i"), (F.size("ta") + F.size("tb")).alias("s")).where(F.col("i") * 100 >= (F.col("s") - F.col("i")) * percent).select("a", "b")


def link(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, frequent: int = FREQUENT) -> DataFrame:
    """`doc_id, n_shingles, component_id` of every row.

    A null or empty text has an empty set and links with nothing: its component
    is its own id. A null id takes no part and has a null component. Rows with
    the same id are one document for links. Further columns are dropped.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if src.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return _link(src, words, percent, frequent)
    # each text of an id is a node of its own, and the nodes of an id are linked
    tagged = src.withColumn("tag", F.xxhash64("text"))
    nodes = Table(tagged.where("doc_id is not null").select("doc_id", "tag").distinct().withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = Table(_link(tagged.join(nodes.df, ["doc_id", "tag"]).select(F.col("node").alias("doc_id"), "text").dropDuplicates(["doc_id"]), words, percent, frequent), "found")
    same = nodes.df.join(nodes.df.groupBy("doc_id").agg(F.min("node").alias("b")), "doc_id").select(F.col("node").alias("a"), "b")
    joined = components(found.df.select(F.col("doc_id").alias("a"), F.col("component_id").alias("b")).union(same))
    whole = nodes.df.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = whole.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    rows = whole.join(names, "component").join(found.df.select(F.col("doc_id").alias("node"), "n_shingles"), "node").select("doc_id", "tag", "n_shingles", "component_id")
    known = tagged.where("doc_id is not null").join(rows, ["doc_id", "tag"]).select("doc_id", "n_shingles", "component_id")
    return known.unionByName(_link(src.where("doc_id is null"), words, percent, frequent))


def _link(src: DataFrame, words: int, percent: int, frequent: int) -> DataFrame:
    """`link` of rows whose ids are different or null."""
    spark = src.sparkSession
    full = Table(_sets(src, words, percent), "prefixes")
    sets = Table(full.df.drop("prefix", "least"), "sets")
    classes = Table(sets.df.where("n > 0 and doc_id is not null").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep")), "classes")
    copies = Table(sets.df.join(classes.df, ["n", "s1", "s2"]).where("doc_id <> rep").select("doc_id"), "copies")
    reps = full.df.where(f"n >= {_least_size(percent)} and doc_id is not null").join(F.broadcast(copies.df) if copies.small() else copies.df, "doc_id", "left_anti").withColumnRenamed("doc_id", "rep")
    exploded = reps.select("rep", F.explode("prefix").alias("token"))
    met = _shared(exploded, "token").groupBy("rep").count()
    onward = Table(met.join(full.df.select(F.col("doc_id").alias("rep"), "least"), "rep").where("count >= least").select("rep"), "onward")
    full.drop()
    release(spark)
    ids = onward.df.withColumnRenamed("rep", "doc_id")
    chosen = src.join(F.broadcast(ids) if onward.small() else ids, "doc_id", "left_semi").select(F.col("doc_id").alias("rep"), "text")
    tokens = Table(_tokens(chosen, words), "tokens")
    release(spark)
    every = tokens.df.select("rep", F.explode("tokens").alias("h"))
    counts = every.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    ordered = every.join(counts, "h").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("toks"))
    ordered = ordered.join(tokens.df.select("rep", F.size("tokens").cast("long").alias("n")), "rep")
    rows = Table(_signatures(ordered, percent, frequent), "signatures")
    index = Table(_shared(rows.df, "key"), "index")
    release(spark)
    fits = lambda x, y: F.least(x["most"], y["most"]) * 100 >= (x["n"] + y["n"] - F.least(x["most"], y["most"])) * percent

    # each class with the hub of the bucket that has the best one
    hubs = Table(index.df.groupBy("key").agg(F.min(F.struct("rares", "rep", "n", "most")).alias("hub")), "hubs")
    x, y = index.df, F.col("hub")
    star = x.join(hubs.df, "key").where((F.col("rep") != F.col("hub.rep")) & fits({"most": F.col("most"), "n": F.col("n")}, {"most": F.col("hub.most"), "n": F.col("hub.n")}))
    star = star.groupBy("rep").agg(F.min(F.struct(y["rares"], y["rep"])).alias("hub")).select(F.least("rep", "hub.rep").alias("a"), F.greatest("rep", "hub.rep").alias("b")).distinct()
    first = Table(_verified(star, tokens.df, percent), "first")
    own = components(first.df)

    # what is still apart
    placed = index.df.join(own.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    placed = Table(placed, "placed")
    sizes = placed.df.groupBy("key", "component").count()
    main = sizes.groupBy("key").agg(F.max_by("component", F.struct("count", "component")).alias("main"), F.count("*").alias("parts")).where("parts > 1").select("key", "main")
    main = Table(main, "main")
    mixed = Table(placed.df.join(main.df, "key").join(tokens.df.select("rep", "odd"), "rep"), "mixed")
    l, r = mixed.df.where("component <> main").alias("l"), mixed.df.alias("r")
    apart = (F.col("l.component") != F.col("r.component")) & ((F.col("r.component") == F.col("r.main")) | (F.col("l.rep") < F.col("r.rep")))
    side = lambda s: {"most": F.col(f"{s}.most"), "n": F.col(f"{s}.n")}
    alike = _differing(F.col("l.odd"), F.col("r.odd")) * (100 + percent) <= (F.col("l.n") + F.col("r.n")) * (100 - percent)
    pairs = l.join(r, (F.col("l.key") == F.col("r.key")) & apart & fits(side("l"), side("r")) & alike)
    pairs = pairs.select(F.least("l.rep", "r.rep").alias("a"), F.greatest("l.rep", "r.rep").alias("b")).distinct()
    second = Table(_verified(pairs, tokens.df, percent), "second")

    links = first.df.union(second.df)
    home = components(links).select(F.col("node").alias("rep"), "component")
    whole = classes.df.join(home, "rep", "left").select("n", "s1", "s2", F.coalesce("component", "rep").alias("component"))
    out = sets.df.join(whole, ["n", "s1", "s2"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    for t in (tokens, rows, index, hubs, first, placed, main, mixed, second, onward, copies):
        t.drop()
    return out
