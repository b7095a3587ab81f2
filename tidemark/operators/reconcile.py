"""Old against new versions of records: cascading keys, multisets, first-in-first-out matches, upserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_NULL = "\0"


def _line(cols: list[Column]) -> Column:
    """One string for a composite key; nulls are equal to each other."""
    return F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit(_NULL)) for c in cols])


def match_key(timestamp: Column, symbol: Column, by_symbol: bool) -> Column:
    """struct<ts, sym> by which stored and source rows are grouped: the symbol counts only if asked for."""
    text = lambda c: F.trim(F.coalesce(c.cast("string"), F.lit("")))
    return F.struct(text(timestamp).alias("ts"), (F.upper(text(symbol)) if by_symbol else F.lit("")).alias("sym"))


def json_or_null(x: Column) -> Column:
    """The text if it is JSON, else null."""
    return F.when(F.try_parse_json(F.nullif(F.trim(x), F.lit(""))).isNotNull(), x)


def cascade_match(old: DataFrame, old_id: str, new: DataFrame, new_id: str, keys: list[list[str]], seq: str) -> DataFrame:
    """`new_id, old_id, key_no` of every new row with the first composite key that hits, the last old row of that key.

    All keys are probed in one join: rows of both sides are exploded by key number.
    """
    tagged = lambda df: F.explode(F.array(*[F.struct(F.lit(i).alias("key_no"), _line([F.col(c) for c in ks]).alias("key")) for i, ks in enumerate(keys)]))
    index = old.select(old_id, seq, tagged(old).alias("k")).groupBy("k.key_no", "k.key").agg(F.max_by(old_id, F.struct(seq, old_id)).alias(old_id))
    probe = new.select(new_id, tagged(new).alias("k")).select(new_id, "k.key_no", "k.key")
    hits = probe.join(index, ["key_no", "key"])
    return hits.groupBy(new_id).agg(F.min(F.struct("key_no", old_id)).alias("m")).select(new_id, f"m.{old_id}", "m.key_no")


def closure(matches: DataFrame, old: DataFrame, old_id: str, new_id: str, uid: str) -> DataFrame:
    """Adds old rows that share a uid with a matched one, to the same (smallest) new id; direct matches stay."""
    direct = matches.select(old_id, new_id)
    by_uid = direct.join(old.select(old_id, uid), old_id).where(F.col(uid).isNotNull()).groupBy(uid).agg(F.min(new_id).alias(new_id))
    kin = old.select(old_id, uid).join(by_uid, uid).select(old_id, new_id).join(direct.select(old_id), old_id, "left_anti")
    return direct.withColumn("direct", F.lit(True)).unionByName(kin.withColumn("direct", F.lit(False)))


def split_matched(rows: DataFrame, matches: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    ids = matches.select(key).distinct()
    return rows.join(ids, key, "left_semi"), rows.join(ids, key, "left_anti")


def candidate_join(left: DataFrame, id_: str, cands: Column, index: DataFrame, alias: str, carry: str) -> DataFrame:
    """Each left row with `carry` of the first of its candidate keys that the index has."""
    probes = left.select(id_, F.posexplode(cands).alias("pos", alias))
    best = probes.join(index, alias).groupBy(id_).agg(F.min_by(carry, F.struct("pos", carry)).alias(carry))
    return left.join(best, id_, "left")


def fifo_dates(stored: DataFrame, source: DataFrame, bucket: list[str], order: list[str], date: str = "date") -> DataFrame:
    """Stored rows with a date filled in: the k-th dateless row of a bucket takes the k-th source row's date.

    Equal keys share a partition only by whole buckets; the join is on (bucket, k).
    """
    rank = F.row_number().over(Window.partitionBy(*bucket, F.col(date).isNull()).orderBy(*order))
    left = stored.withColumn("__k", F.when(F.col(date).isNull(), rank))
    right = source.withColumn("__k", F.row_number().over(Window.partitionBy(*bucket).orderBy(*order))).select(*bucket, "__k", F.col(date).alias("__d"))
    on = reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in bucket] + [left["__k"] == right["__k"]])
    return left.join(right, on, "left").select(*[left[c] for c in stored.columns if c != date], F.coalesce(left[date], right["__d"]).alias(date))


def _consume(stored: list[tuple], left: list[tuple]) -> list[tuple]:
    """Rows (pos, type, price, amount, date) with dates of the source rows (type, price, amount, date) that they use up."""
    out = [list(r) for r in stored]
    for typed in (True, False):
        for row in out:
            known = row[1] not in (None, "", "unknown")
            if row[4] is not None or known != typed:
                continue
            at = next((j for j, (t, p, m, _) in enumerate(left) if p == row[2] and m == row[3] and (not known or t == row[1])), None)
            if at is not None:
                t, _, _, row[4] = left.pop(at)
                row[1] = row[1] if known else t
    return [tuple(r) for r in out]


def fifo_wildcard(stored: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Like `fifo_dates` within a filing, but a stored row of unknown type may take any leftover of its price and amount.

    Consumption is sequential, so each filing's rows are walked in order within a
    sorted partition; `key, pos, type, price, amount, date` on both sides. A filing
    has few rows; one at a time is held.
    """
    cols = [key, "pos", "type", "price", "amount", "date"]
    both = source.select(*cols).withColumn("__stored", F.lit(False)).unionByName(stored.select(*cols).withColumn("__stored", F.lit(True)))
    rows = both.repartition(F.col(key)).sortWithinPartitions(key, "__stored", "pos").select(*cols, "__stored")

    def run(batches):
        import pyarrow as pa

        at, left, mine = None, [], []
        for batch in batches:
            out = []
            for k, *row, is_stored in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if k != at:
                    out += [(at, *r) for r in _consume(mine, left)]
                    at, left, mine = k, [], []
                if is_stored:
                    mine.append(tuple(row))
                else:
                    left.append(tuple(row[1:]))
            yield pa.RecordBatch.from_arrays([pa.array(c, batch.schema.field(i).type) for i, c in enumerate(zip(*out, strict=True))] if out else [pa.array([], f.type) for f in list(batch.schema)[:6]], cols)
            kinds = [f.type for f in list(batch.schema)[:6]]
        if mine:
            out = [(at, *r) for r in _consume(mine, left)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], cols)

    return rows.mapInArrow(run, stored.select(*cols).schema)


def multiset(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n"))


def multiset_diff(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """`key, missing, extra`: how often b has it less often, and more often, than a (U2, A14). Both sides are counted before they meet."""
    both = a.select(*key, F.lit(1).alias("__s")).unionByName(b.select(*key, F.lit(-1).alias("__s"))).groupBy(*key).agg(F.sum("__s").alias("d")).where("d <> 0")
    return both.select(*key, F.greatest("d", F.lit(0)).alias("missing"), F.greatest(-F.col("d"), F.lit(0)).alias("extra"))


def upsert(table: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """The table with changed rows replaced and new ones added (K4)."""
    return table.join(changes.select(*key).distinct(), key, "left_anti").unionByName(changes, allowMissingColumns=True)


def update_only(table: DataFrame, changes: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """Existing rows with non-null changes taken over, and `changed`."""
    new = changes.select(*key, *[F.col(c).alias(f"__{c}") for c in cols])
    out = table.join(new, key, "left")
    diff = reduce(lambda a, b: a | b, [F.col(f"__{c}").isNotNull() & ~F.col(f"__{c}").eqNullSafe(F.col(c)) for c in cols])
    return out.select(*[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in cols else F.col(c) for c in table.columns], diff.alias("changed"))
