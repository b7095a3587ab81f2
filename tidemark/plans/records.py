"""Queries over records: lookups, duplicates, reconciliation, windows, orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, dates, text
from ..operators import alerts, dedupe, filters, fuzzy, lookup, reconcile
from .tables import ORDER, read

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add



@query("""WITH a AS (SELECT page_id, url AS alias FROM pages UNION ALL SELECT page_id, nullif(regexp_extract(rtrim(url, '/'), '[^/]*$'), '') FROM pages UNION ALL SELECT page_id, regexp_replace(regexp_extract(rtrim(url, '/'), '[^/]*$'), '(.)\\.[^.]*$', '\\1') FROM pages),
 idx AS (SELECT alias, max(page_id) AS hit FROM a WHERE alias IS NOT NULL GROUP BY alias),
 q AS (SELECT page_id, regexp_extract(rtrim(url, '/'), '[^/]*$') AS name FROM pages),
 p AS (SELECT page_id, 0 AS pri, name AS alias FROM q UNION ALL SELECT page_id, 2, regexp_replace(name, '(.)\\.[^.]*$', '\\1') FROM q)
 SELECT page_id, arg_min(hit, pri) AS hit FROM p JOIN idx USING (alias) GROUP BY page_id""")
def alias_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    index = lookup.alias_index(pages.select(F.col("page_id").alias("hit"), "url"), "url", "hit")
    probes = pages.select("page_id", text.basename(F.col("url")).alias("name"))
    return lookup.alias_join(probes, "page_id", ["name"], index, ["hit"]).where("hit is not null").select("page_id", "hit")


@query("""SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id, event_type""")
def lookup_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return lookup.last_wins(ev, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("""SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id, event_type""")
def first_wins_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    return dedupe.first_wins(ev, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("""SELECT o_orderkey, CASE WHEN row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY (o_orderpriority LIKE '1%') DESC, substr(o_orderpriority, 1, 1) DESC, o_orderkey) > 1 THEN 'duplicate_in_batch' END AS skip_reason FROM orders""")
def batch_dedupe_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return dedupe.batch_dedupe(o, ["o_custkey", "o_orderstatus"], F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority"), ["o_orderkey"]).select("o_orderkey", "skip_reason")


_HASH = "sha256(concat_ws('|', lower(trim(o_orderstatus)), lower(trim(o_orderpriority)), CAST(CAST(round(CAST(o_custkey AS DECIMAL(28,10)), 6) AS DECIMAL(28,6)) AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d')))"


def _hashed(o: DataFrame) -> DataFrame:
    return o.withColumn("hash", dedupe.filing_hash([F.col("o_orderstatus"), F.col("o_orderpriority")], [F.col("o_custkey")], F.date_format("o_orderdate", "yyyy-MM-dd")))


@query(f"""WITH h AS (SELECT *, {_HASH} AS hash FROM orders) SELECT o_orderkey, hash FROM h WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND hash NOT IN (SELECT hash FROM h WHERE o_orderdate < TIMESTAMP '2000-01-01')""")
def hash_antijoin_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _hashed(read(spark, sf_dir, "orders"))
    return dedupe.new_rows(h.where("o_orderdate >= timestamp'1999-01-01'"), h.where("o_orderdate < timestamp'2000-01-01'"), ["hash"]).select("o_orderkey", "hash")


@query(f"""WITH h AS (SELECT *, {_HASH} AS hash FROM orders), b AS (SELECT hash, count(*) AS n FROM h WHERE o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY hash), s AS (SELECT DISTINCT hash FROM h WHERE o_orderdate < TIMESTAMP '2000-01-01')
 SELECT CAST(sum(n) AS BIGINT) AS input, count(*) AS unique_rows, count(s.hash) AS existing, count(*) - count(s.hash) AS to_insert FROM b LEFT JOIN s USING (hash)""")
def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _hashed(read(spark, sf_dir, "orders"))
    return dedupe.statistics(h.where("o_orderdate >= timestamp'1999-01-01'"), h.where("o_orderdate < timestamp'2000-01-01'"), ["hash"])


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Old orders, and new ones with a status, priority or customer changed here and there."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.col("o_orderdate").cast("date").alias("day"))
    k = F.col("o_orderkey")
    new = o.select(k.alias("new_id"), F.when(k % 11 == 0, None).otherwise(F.col("o_custkey")).alias("o_custkey"), F.when(k % 3 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), F.when(k % 5 == 0, "X").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"), F.when(k % 13 == 0, None).otherwise(F.col("day")).alias("day"))
    return o.withColumnRenamed("o_orderkey", "old_id"), new


_KEYS = [["o_custkey", "day", "o_orderstatus", "o_orderpriority"], ["o_custkey", "day", "o_orderstatus"], ["o_custkey", "day"], ["o_custkey", "o_orderpriority"]]
_VERSIONS = """old AS (SELECT o_orderkey AS old_id, o_custkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders),
 new AS (SELECT o_orderkey AS new_id, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderpriority END AS o_orderpriority, CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders)"""
_CASCADE = _VERSIONS + ", hits AS (" + " UNION ALL ".join(f"SELECT new_id, {i} AS key_no, max(old_id) AS old_id FROM new JOIN old ON {' AND '.join(f'new.{c} IS NOT DISTINCT FROM old.{c}' for c in ks)} GROUP BY new_id" for i, ks in enumerate(_KEYS)) + "), m AS (SELECT new_id, arg_min(old_id, key_no) AS old_id, min(key_no) AS key_no FROM hits GROUP BY new_id)"


@query(f"WITH {_CASCADE} SELECT new_id, old_id, key_no FROM m")
def cascade_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _versions(spark, sf_dir)
    return reconcile.cascade_match(old, "old_id", new, "new_id", _KEYS, "old_id")


@query(f"""WITH {_CASCADE}, d AS (SELECT old_id, min(new_id) AS new_id FROM m GROUP BY old_id), u AS (SELECT old_id % 4001 AS uid, min(new_id) AS new_id FROM d WHERE old_id % 7 <> 0 GROUP BY uid),
 k AS (SELECT old.old_id, u.new_id FROM old JOIN u ON u.uid = old.old_id % 4001 AND old.old_id % 7 <> 0 WHERE old.old_id NOT IN (SELECT old_id FROM d))
 SELECT old_id, new_id, true AS direct FROM d UNION ALL SELECT old_id, new_id, false FROM k""")
def uid_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, _ = _versions(spark, sf_dir)
    m = cascade_match(spark, sf_dir).groupBy("old_id").agg(F.min("new_id").alias("new_id"))
    return reconcile.closure(m, old.withColumn("uid", F.when(F.col("old_id") % 7 != 0, F.col("old_id") % 4001)), "old_id", "new_id", "uid")


_LI = ", ".join(ORDER)


@query(f"""WITH db AS (SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS date FROM lineitem), s AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_returnflag, l_quantity ORDER BY {_LI}) AS k FROM lineitem WHERE l_linenumber % 2 = 0),
 d AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_returnflag, l_quantity, date IS NULL ORDER BY {_LI}) AS k FROM db)
 SELECT d.l_orderkey, d.l_linenumber, d.l_partkey, d.l_suppkey, coalesce(d.date, CASE WHEN d.date IS NULL THEN CAST(s.l_shipdate AS DATE) END) AS date FROM d LEFT JOIN s ON d.l_partkey = s.l_partkey AND d.l_returnflag = s.l_returnflag AND d.l_quantity = s.l_quantity AND d.k = s.k AND d.date IS NULL""")
def fifo_date_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select(*ORDER, "l_returnflag")
    db = li.withColumn("date", F.when(F.col("l_linenumber") % 3 == 0, None).otherwise(F.col("l_shipdate").cast("date")))
    src = li.where("l_linenumber % 2 = 0").withColumn("date", F.col("l_shipdate").cast("date"))
    return reconcile.fifo_dates(db, src, ["l_partkey", "l_returnflag", "l_quantity"], ORDER).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "date")


@query("""WITH x AS (SELECT l_partkey, l_quantity, 1 AS s FROM lineitem WHERE l_linenumber <> 2 UNION ALL SELECT l_partkey, l_quantity, -1 FROM lineitem WHERE l_linenumber <> 3) SELECT l_partkey, l_quantity, greatest(sum(s), 0)::BIGINT AS missing, greatest(-sum(s), 0)::BIGINT AS extra FROM x GROUP BY l_partkey, l_quantity HAVING sum(s) <> 0""")
def multiset_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_linenumber")
    out = reconcile.multiset_diff(li.where("l_linenumber <> 2"), li.where("l_linenumber <> 3"), ["l_partkey", "l_quantity"])
    return out.withColumns({c: F.col(c).cast("long") for c in ("missing", "extra")})


@query("""SELECT c_custkey, c_mktsegment, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS matched FROM customer""")
def matched_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    hit, miss = reconcile.split_matched(rows, orders, "c_custkey")
    return hit.withColumn("matched", F.lit(True)).unionByName(miss.withColumn("matched", F.lit(False)))


@query("""WITH idx AS (SELECT strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') AS alias, max(event_id) AS hit FROM events WHERE event_id % 2 = 0 GROUP BY alias),
 p AS (SELECT event_id, 1 AS pos, strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') AS alias FROM events UNION ALL SELECT event_id, 2, strftime(ts, '%Y-%m-%dT%H:%M:%S') FROM events)
 SELECT event_id, arg_min(hit, pos) AS hit FROM p JOIN idx USING (alias) GROUP BY event_id""")
def ts_candidate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("raw"))
    index = ev.where("event_id % 2 = 0").select(F.get(dates.time_candidates(F.col("raw")), F.lit(1)).alias("alias"), "event_id").groupBy("alias").agg(F.max("event_id").alias("hit"))
    return reconcile.candidate_join(ev, "event_id", dates.time_candidates(F.col("raw")), index, "alias", "hit").where("hit is not null").select("event_id", "hit")


@query("""WITH d AS (SELECT trim(regexp_replace(replace(upper(s_name), '&', ' AND '), '[^A-Z0-9]+', ' ', 'g')) AS k, min(s_suppkey) AS symbol FROM supplier GROUP BY k)
 SELECT c_custkey, d.symbol FROM customer LEFT JOIN d ON k = 'SUPPLIER ' || lpad(CAST(c_custkey % 200 AS VARCHAR), 9, '0')""")
def exact_name_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = read(spark, sf_dir, "supplier").select(F.concat(F.lit("PT "), F.col("s_name"), F.lit(" Tbk.")).alias("company_name"), F.col("s_suppkey").alias("symbol"))
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("Supplier-"), F.lpad((F.col("c_custkey") % 200).cast("string"), 9, "0"), F.lit(" (Persero)")).alias("name"))
    return lookup.exact_name(rows, "name", dim).select("c_custkey", "symbol")


_SET = "list_distinct(list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda x: x <> ''))"


@query(f"""WITH d AS (SELECT doc_id, {_SET.format('text')} AS a FROM documents WHERE text IS NOT NULL), i AS (SELECT item_id, {_SET.format('text')} AS b FROM benchmark), n AS (SELECT doc_id, item_id FROM (SELECT doc_id, unnest(a) AS w FROM d) JOIN (SELECT item_id, max(x) AS w FROM (SELECT item_id, unnest(b) AS x FROM i) WHERE length(x) >= 4 GROUP BY item_id) USING (w))
 SELECT doc_id, item_id, round(len(list_intersect(a, b)) / len(list_distinct(a || b)), 9) AS jaccard, len(list_intersect(a, b)) / len(list_distinct(a || b)) < 0.35 AS low FROM n JOIN d USING (doc_id) JOIN i USING (item_id)""")
def token_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and benchmark items that share the item's last word in order, if it has four letters: one block an item."""
    docs = read(spark, sf_dir, "documents").where("text is not null").select("doc_id", fuzzy.word_set(F.col("text")).alias("a"))
    long = lambda c: F.filter(c, lambda w: F.length(w) >= 4)
    items = read(spark, sf_dir, "benchmark").select("item_id", fuzzy.word_set(F.col("text")).alias("b")).withColumn("w", F.array_max(long(F.col("b"))))
    blocks = docs.select("doc_id", F.explode(long(F.col("a"))).alias("w")).join(lookup.small(items.where("w is not null").select("item_id", "w")), "w").select("doc_id", "item_id")
    j = fuzzy.set_jaccard(F.col("a"), F.col("b"))
    both = blocks.join(docs, "doc_id").join(lookup.small(items.select("item_id", "b")), "item_id")
    return both.select("doc_id", "item_id", j.alias("j")).select("doc_id", "item_id", F.round("j", 9).alias("jaccard"), (F.col("j") < 0.35).alias("low"))


@query("SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-07 12:00:00'")
def window_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo, hi = F.lit("2024-01-05 00:00:00").cast("timestamp"), F.lit("2024-01-07 12:00:00").cast("timestamp")
    return read(spark, sf_dir, "events").where(filters.in_window(F.col("ts"), lo, hi)).select("event_id")


@query("SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-07 12:00:00' AND event_type IN (SELECT min(event_type) FROM events)")
def window_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    first = ev.agg(F.min("event_type")).first()[0]
    return ev.where(filters.strictly_between(F.col("ts"), F.lit("2024-01-05").cast("timestamp"), F.lit("2024-01-07 12:00:00").cast("timestamp"), F.col("event_type"), [first])).select("event_id")


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-09 17:00:00' AND ts < TIMESTAMP '2024-01-12 17:00:00'")
def day_range_halfopen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").where(filters.day_range(F.col("ts"), ["2024-01-12", "2024-01-10"])).select("event_id")


@query("SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_type DESC, event_id DESC LIMIT 50")
def sort_publish_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events").select("event_id", "ts", "event_type").withColumns({"date": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), "title": F.col("event_type"), "link": F.lpad(F.col("event_id").cast("string"), 12, "0")})
    return filters.sort_announcements(ev, descending=True).limit(50).select("event_id", "ts", "event_type")


@query("SELECT doc_id, source, running FROM (SELECT doc_id, source, sum(n_chars) OVER (PARTITION BY source ORDER BY n_chars, doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS running FROM documents) WHERE running <= 20000")
def size_budget_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.size_budget(read(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), "n_chars", 20000, "doc_id", ["source"]).select("doc_id", "source", "running")


@query("""SELECT event_type AS code, lower(CASE WHEN value < 20 THEN 'fatal' WHEN value < 50 THEN 'hard' ELSE 'warning' END) AS severity, count(*) AS n FROM events GROUP BY ALL""")
def severity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events").select(F.col("event_type").alias("code"), F.when(F.col("value") < 20, "FATAL").when(F.col("value") < 50, "Hard").alias("severity"))
    return alerts.severity_counts(alerts.with_defaults(ev), "code")


@query("SELECT CAST(user_id AS VARCHAR) AS code, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, code LIMIT 5")
def top5_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.top_codes(read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("code")))


@query(f"""SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LI}) - 1 AS pos, CASE l_returnflag WHEN 'R' THEN 'buy' WHEN 'A' THEN 'sell' ELSE 'other' END AS type, l_quantity AS price, CASE WHEN row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LI}) > 1 THEN CAST(l_partkey AS BIGINT) END AS amount FROM lineitem""")
def parallel_array_reshape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parallel arrays of each filing, the amounts' first one cut off and nulled in front, expanded again."""
    kind = F.when(F.col("l_returnflag") == "R", "buy").when(F.col("l_returnflag") == "A", "sell").alias("type")
    rows = F.array_sort(F.collect_list(F.struct(*ORDER, kind)))
    doc = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(rows.alias("r"))
    amounts = F.concat(F.array(F.lit(None).cast("bigint")), F.transform(F.slice("r", F.lit(2), F.greatest(F.size("r") - 1, F.lit(0))), lambda x: x["l_partkey"]))
    txs = arrays.zip_transactions(F.lit(None).cast("array<string>"), F.transform("r", lambda x: x["type"]), F.transform("r", lambda x: x["l_quantity"]), amounts)
    return doc.select("l_orderkey", F.posexplode(txs).alias("pos", "t")).select("l_orderkey", F.col("pos").cast("long").alias("pos"), "t.type", "t.price", "t.amount")


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 1 AS n_rows FROM events""")
def json_shape_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows under any container key, whichever wraps them."""
    k = F.col("event_id") % 3
    raw = F.when(k == 0, F.concat(F.lit("["), F.col("props"), F.lit("]"))).when(k == 1, F.concat(F.lit('{"rows":['), F.col("props"), F.lit("]}"))).otherwise(F.concat(F.lit('{"data":['), F.col("props"), F.lit("]}")))
    got = arrays.rows_of(raw)
    return read(spark, sf_dir, "events").select("event_id", F.try_variant_get(F.get(got, F.lit(0)), "$.k", "bigint").alias("k"), F.size(got).alias("n_rows"))


@query("""SELECT event_id, list_filter([CASE WHEN user_id % 2 = 0 THEN 'symbol' END, CASE WHEN event_type = (SELECT min(event_type) FROM events) THEN 'holder_name' END, CASE WHEN event_id % 5 = 0 THEN 'transaction_type' END], lambda x: x IS NOT NULL) AS missing FROM events""")
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    first = ev.agg(F.min("event_type")).first()[0]
    rows = ev.select("event_id", F.when(F.col("user_id") % 2 == 1, F.col("user_id").cast("string")).alias("symbol"), F.lit("2024").alias("timestamp"), F.when(F.col("event_type") == first, " ").otherwise(F.col("event_type")).alias("holder_name"), F.when(F.col("event_id") % 5 == 0, "0").otherwise("buy").alias("transaction_type"))
    return rows.select("event_id", filters.missing_columns().alias("missing"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'CHANGED' ELSE o_orderstatus END AS o_orderstatus, o_orderkey % 10 = 0 AS changed FROM orders""")
def update_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return reconcile.update_only(o, o.where("o_orderkey % 10 = 0").select("o_orderkey", F.lit("CHANGED").alias("o_orderstatus")), ["o_orderkey"], ["o_orderstatus"])


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'CHANGED' ELSE o_orderstatus END AS o_orderstatus FROM orders UNION ALL SELECT -o_orderkey, 'NEW' FROM orders WHERE o_orderkey % 100 = 0 AND o_orderkey > 0""")
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    changes = o.where("o_orderkey % 10 = 0").select("o_orderkey", F.lit("CHANGED").alias("o_orderstatus")).unionByName(o.where("o_orderkey % 100 = 0 and o_orderkey > 0").select((-F.col("o_orderkey")).alias("o_orderkey"), F.lit("NEW").alias("o_orderstatus")))
    return reconcile.upsert(o, changes, ["o_orderkey"])


@query()
def fuzzy_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three suppliers nearest to each customer's (changed) name; scored by an Arrow UDF, so rows only."""
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("Suplier "), F.lpad((F.col("c_custkey") % 100).cast("string"), 9, "0")).alias("name"))
    dim = read(spark, sf_dir, "supplier").select("s_suppkey", F.replace("s_name", F.lit("#"), F.lit(" ")).alias("s_label"))
    return fuzzy.nearest(rows, "c_custkey", "name", dim, "s_suppkey", "s_label")


@query()
def fuzzy_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("Suplier "), F.lpad((F.col("c_custkey") % 100).cast("string"), 9, "0")).alias("name"))
    dim = read(spark, sf_dir, "supplier").select("s_suppkey", F.replace("s_name", F.lit("#"), F.lit(" ")).alias("s_label"))
    return fuzzy.best_match(rows, "c_custkey", "name", dim, "s_suppkey", "s_label", 80.0)


@query()
def token_set_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.when(F.col("user_id") % 3 == 0, "Report of ownership of public companies").when(F.col("user_id") % 3 == 1, "Laporan bulanan registrasi").otherwise(F.col("event_type"))
    got = fuzzy.classify_title(F.col("title"), ["report of ownership or any changes in share ownership of public companies"], ["laporan bulanan registrasi pemegang efek"])
    ids = read(spark, sf_dir, "events").select("event_id", title.alias("title"))
    scored = ids.select("title").distinct().select("title", got.alias("c"))
    return ids.join(scored, "title").select("event_id", "c.format", "c.idx_score", "c.non_idx_score")


@query()
def fifo_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dateless rows of each filing, some of unknown type, take dates of its source rows in order."""
    from pyspark.sql import Window

    pos = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*ORDER)).cast("int")
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", pos.alias("pos"), F.col("l_returnflag").alias("type"), F.col("l_quantity").alias("price"), F.col("l_linenumber").cast("long").alias("amount"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"))
    stored = rows.withColumn("type", F.when(F.col("pos") % 2 == 0, "unknown").otherwise(F.col("type"))).withColumn("date", F.when(F.col("pos") == 1, F.col("date")))
    return reconcile.fifo_wildcard(stored, rows, "l_orderkey")
