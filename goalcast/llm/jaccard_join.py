"""Exact Jaccard self-join of word-shingle sets with adaptive multi-match prefixes.

Documents with equal shingle sets form a class; classes are joined. All tokens (64-bit shingle
hashes) share one global order: the tokens of a fixed hash range ("zone") by document frequency,
then the others by hash. If two sets overlap in at least ``t`` tokens, the first ``n - t + l``
tokens of both share at least ``l`` (the l-prefix); each class picks the ``l`` with the smallest
estimated cost, and a pair is verified only if it shares the smaller of its two ``l``.

Token frequencies count all documents in a packed exchange. A token that occurs once fills a
prefix position but yields no candidate, so most documents leave before any pair is made.
Classes that share a prefix token meet in the family of that token's smallest class. A large
family is compared chunk by chunk as far as its components ask for it (``families``), and a task
returns only a spanning forest of the links it verified, so no group emits its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalcast.llm import packed
from goalcast.llm.families import family_components, linked, overlaps
from goalcast.llm.shingles import class_id, full_sets, shingle_sets
from goalcast.session import cut_lineage, read_table

U64 = np.uint64
#: Longest l considered, classes in a chunk of a family.
LONGEST, CHUNK = 4, 256
#: Rows of ids broadcast at most (about 110 bytes each once hashed); more go through a shuffle join.
ID_LIMIT = 500_000

_SETS = "doc_id long, th long, rid long, n long, s long, cid binary, pool binary"


def _need(n: np.ndarray | int, num: int, den: int):
    """Overlap that a set of ``n`` tokens needs with any partner."""
    return -(-n * num // den)


def _set_rows(k: int, num: int, den: int, zone: int) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("rid", pa.int64()), ("n", pa.int64()), ("s", pa.int64()),
                        ("cid", pa.binary()), ("pool", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 31
        for b in batches:
            ns, ss, cids, pools = [], [], [], []
            for x in shingle_sets(b.column(2), k):
                n = len(x)
                s = int(np.searchsorted(x, U64(zone)))
                ns.append(n)
                ss.append(s)
                cids.append(class_id(x))
                pools.append(x[:max(s, min(n, n - _need(n, num, den) + LONGEST))].tobytes())
            ids = np.arange(rid, rid + len(ns))
            rid += len(ns)
            yield packed.batch(schema, [b.column(0), b.column(1), ids, ns, ss, cids, pools])
    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(tokens, rid, in zone) of bounded blocks of classes, copies within a block left out."""
    def flush():
        r = np.repeat(np.array(rids, dtype=np.int64), [len(x) for x in pools])
        at = np.concatenate([np.arange(len(x)) for x in pools]) < np.repeat(zones, [len(x) for x in pools])
        return np.concatenate(pools), r, at
    pools, rids, zones, seen, held = [], [], [], {}, 0
    for b in batches:
        for rid, s, cid, pool in zip(*(b.column(c).to_pylist() for c in ("rid", "s", "cid", "pool"))):
            if cid is None:
                continue
            if cid in seen:                                    # the class is known by its smallest rid
                rids[seen[cid]] = min(rids[seen[cid]], rid)
                continue
            if held >= packed.BLOCK:
                yield flush()
                pools, rids, zones, seen, held = [], [], [], {}, 0
            seen[cid] = len(rids)
            pools.append(np.frombuffer(pool, dtype=U64))
            rids.append(rid)
            zones.append(s)
            held += len(pools[-1])
    if pools:
        yield flush()


def _send_counts(buckets: int) -> Callable:
    schema = pa.schema([("bucket", pa.int32()), ("low", pa.binary()), ("cnt", pa.binary())])

    def run(batches):
        for tokens, _, _ in _blocks(batches):
            keys, cnt = np.unique(tokens, return_counts=True)
            rows = [(b, packed.low32(k), c.astype(np.uint32).tobytes())
                    for b, k, c in packed.split_by_bucket(keys, buckets, cnt)]
            yield packed.rows(schema, rows)
    return run


def _sum_counts(table: pa.Table) -> pa.Table:
    """Tokens of one bucket that occur twice or more, with their frequency; and all entries it gets."""
    low, cnt = packed.joined(table["low"], np.uint32), packed.joined(table["cnt"], np.uint32)
    order = np.argsort(low, kind="stable")
    low, cnt = low[order], cnt[order].astype(np.int64)
    first = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    df = np.add.reduceat(cnt, first)
    keep = df > 1
    return pa.table({"bucket": pa.array([table["bucket"][0].as_py()], pa.int32()),
                     "low": pa.array([low[first][keep].tobytes()], pa.binary()),
                     "df": pa.array([df[keep].tobytes()], pa.binary()), "total": pa.array([int(df.sum())], pa.int64())})


def _send_entries(buckets: int, salts: np.ndarray) -> Callable:
    schema = pa.schema([("bucket", pa.int32()), ("salt", pa.int32()), ("low", pa.binary()), ("rid", pa.binary())])

    def run(batches):
        salt = TaskContext.get().partitionId()
        for tokens, rid, zone in _blocks(batches):
            salt += 1
            ref = (rid << 1) | zone                          # the zone flag rides in the lowest bit
            rows = [(b, salt % int(salts[b]), packed.low32(k), r.tobytes())
                    for b, k, r in packed.split_by_bucket(tokens, buckets, ref)]
            yield packed.rows(schema, rows)
    return run


def _look_up(entries: pa.Table, freq: pa.Table) -> pa.Table:
    """Entries whose token occurs twice or more."""
    out = {"rid": np.zeros(0, np.int64), "zone": np.zeros(0, bool), "df": np.zeros(0, np.int64), "token": np.zeros(0, np.int64)}
    if entries.num_rows and freq.num_rows:
        low, ref = packed.joined(entries["low"], np.uint32), packed.joined(entries["rid"], np.int64)
        keys, df = packed.joined(freq["low"], np.uint32), packed.joined(freq["df"], np.int64)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, low), len(keys) - 1)
            hit = keys[at] == low
            out = {"rid": ref[hit] >> 1, "zone": (ref[hit] & 1).astype(bool), "df": df[at[hit]],
                   "token": packed.token_key(entries["bucket"][0].as_py(), low[hit])}
    return pa.table(out)


def _prefixes(found: DataFrame, sets: DataFrame, reps: DataFrame, num: int, den: int) -> DataFrame:
    """Classes that can have a partner, with their l and the shared tokens of their l-prefix."""
    per = (found.groupBy("rid")
           .agg(F.sort_array(F.collect_list(F.when(F.col("zone"), F.struct("df", "token")))).alias("near"),
                F.sort_array(F.collect_list(F.when(~F.col("zone"), F.struct("df", "token")))).alias("far"))
           .join(sets.where("cid is not null").select("rid", "n", "s"), "rid")
           .join(reps.select("rid"), "rid", "left_semi")
           .withColumn("t", F.expr(f"(n * {num} + {den - 1}) div {den}"))
           .withColumn("unique", F.col("s") - F.size("near")))
    for l in range(1, LONGEST + 1):
        length = f"(n - t + {l})"
        per = (per.withColumn(f"k{l}", F.expr(f"int(greatest(0, least(size(near), {length} - unique)))"))
               .withColumn(f"p{l}", F.expr(f"concat(slice(near, 1, k{l}), if({length} > s, far, slice(far, 1, 0)))"))
               .withColumn(f"scan{l}", F.expr(f"aggregate(p{l}, 0L, (x, y) -> x + y.df)")))
    # an l-prefix with fewer than l shared tokens rules out every partner
    alive = " and ".join(f"(t < {l} or size(p{l}) >= {l})" for l in range(1, LONGEST + 1))
    # cost of l: entries scanned, plus at most scan / l candidates, each merged over about 2 n tokens
    cost = [f"if(t < {l}, null, struct(scan{l} + scan{l} / {l} * n / 64 as cost, {l} as l, p{l} as p))"
            for l in range(1, LONGEST + 1)]
    return (per.where(alive).withColumn("best", F.expr(f"array_min(array_compact(array({', '.join(cost)})))"))
            .select("rid", "n", F.col("best.l").alias("l"),
                    F.expr("transform(best.p, x -> x.token)").alias("tokens")))


def _verify(num: int, den: int) -> Callable:
    """Links among candidates: enough shared prefix tokens, sizes that allow it, exact overlap."""
    def check(table: pa.Table, a: np.ndarray, b: np.ndarray, cand: np.ndarray) -> np.ndarray:
        n, l = (table[c].to_numpy() for c in ("n", "l"))
        lists = table["tokens"].combine_chunks()
        prefix = np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1])
        shared = overlaps([prefix[x] for x in a], [prefix[x] for x in b])
        small, large = np.minimum.outer(n[a], n[b]), np.maximum.outer(n[a], n[b])
        cand = cand & (shared >= np.minimum.outer(l[a], l[b])) & (small * den >= large * num)
        return linked([np.frombuffer(x, dtype=U64) for x in table["tokens_all"].to_pylist()], a, b, cand, num, den)
    return check


_FIRST = "min(struct(doc_id is null as no_id, doc_id, th, rid))"


def _components(docs: DataFrame, k: int, num: int, den: int, id_limit: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``(doc_id, th, rid, n, cid)`` and, per class, ``(cid, least)``: the first row of its
    component by (doc_id, th, rid), null ids last. ``th`` is ``xxhash64(text)``."""
    spark = docs.sparkSession
    packed.small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("th", F.xxhash64("text"))
    # the zone holds twice the tokens that a 1-prefix takes on average: with fewer to choose from,
    # tokens of common passages enter the prefixes and families grow
    zone = min(2 ** 64 - 1, 2 ** 64 * 2 * (den - num) // den)
    sets = cut_lineage(docs.select("doc_id", "th", "text").mapInArrow(packed.lean(_set_rows(k, num, den, zone)), _SETS), "jaccard-sets")
    classes = cut_lineage(sets.where("cid is not null").groupBy("cid")
                          .agg(F.min("rid").alias("rid"), F.expr(_FIRST).alias("least")), "jaccard-classes")

    cols = sets.select("rid", "s", "cid", "pool")
    size = sets.agg(F.sum(F.octet_length("pool") / 8)).collect()[0][0]        # one row
    buckets = packed.bucket_count(spark, int(size or 0))
    freq = cut_lineage(cols.mapInArrow(packed.lean(_send_counts(buckets)), "bucket int, low binary, cnt binary")
                       .groupBy("bucket").applyInArrow(_sum_counts, "bucket int, low binary, df binary, total long"), "jaccard-freq")
    salts = packed.bucket_salts(freq, buckets)
    entries = cols.mapInArrow(packed.lean(_send_entries(buckets, salts)), "bucket int, salt int, low binary, rid binary")
    salted = freq.withColumn("salt", F.explode(F.expr(f"sequence(0, {packed.salts_of('total')} - 1)"))).drop("total")
    found = (entries.groupBy("bucket", "salt").cogroup(salted.groupBy("bucket", "salt"))
             .applyInArrow(_look_up, "rid long, zone boolean, df long, token long"))
    prefixes = cut_lineage(_prefixes(found, sets, classes, num, den), "jaccard-prefixes")

    entry = prefixes.select("rid", F.explode("tokens").alias("token"))
    lists = entry.groupBy("token").agg(F.min("rid").alias("leader"), F.max("rid").alias("last")).where("leader < last")
    member = cut_lineage(entry.join(lists.select("token", "leader"), "token").select("leader", "rid").distinct(),
                         "jaccard-members")
    wanted = cut_lineage(sets.where("cid is not null").join(member.select("rid").distinct(), "rid").select("rid", "doc_id", "cid"),
                         "jaccard-wanted")
    full = full_sets(docs, wanted, k, id_limit, "jaccard-full", prefixes)
    roots = family_components(member, lambda rows: rows.join(full, "rid"), _verify(num, den), CHUNK, "jaccard")

    joined = roots.withColumnRenamed("node", "rid").join(classes, "rid")
    least = joined.groupBy("root").agg(F.min("least").alias("component"))
    joined = joined.join(least, "root").select("rid", "component")
    return sets.select("doc_id", "th", "rid", "n", "cid"), classes.join(joined, "rid", "left").select(
        "cid", F.coalesce("component", "least").alias("least"))


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5,
                       id_limit: int = ID_LIMIT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs`` (columns doc_id, text;
    others are ignored): words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, sets of distinct
    ``k``-word shingles, links at Jaccard >= ``num / den``; exact up to collisions of 64-bit shingle
    hashes and, among the prefix tokens of one text, of bucket bits and 32 more (41 at least, more
    with more tokens; two of its tokens on one key could hide a link).

    Defined cases: a null or wordless text has 0 shingles and links with nothing (its component
    is its own doc_id); a text of fewer than ``k`` words is one shingle; repeated doc_ids are
    judged row by row; a null doc_id is never a component id while another id is in reach
    (a component of null ids only has a null id). An empty table gives an empty result.
    """
    rows, classes = _components(docs, k, num, den, id_limit)
    return (rows.join(classes, "cid", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id")))


def keep_one(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_limit: int = ID_LIMIT) -> DataFrame:
    """``docs`` with one row of every component (the one with the smallest doc_id); rows without
    words all stay. All columns stay as they are."""
    rows, classes = _components(docs, k, num, den, id_limit)
    first = (rows.join(classes, "cid", "left").where("cid is null or rid = least.rid")
             .groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th"))
             .agg(F.count("cid").alias("_n")))
    # rows that share id and text with others: one of them stays (all, where there are no words)
    same = rows.where("cid is not null").groupBy("doc_id", "th").agg((F.count(F.lit(1)) > 1).alias("_many"))
    first = cut_lineage(first.join(same, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_th") == F.col("th")), "left")
                        .select("_id", "_th", F.coalesce("_many", F.lit(False)).alias("_many")), "jaccard-first")
    side = F.broadcast(first) if first.count() <= id_limit else first    # at most id_limit rows
    whole = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_doc"),
                        F.xxhash64(F.col("text").cast("string")).alias("_key"))
    kept = whole.join(side, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_th")))
    single = kept.where("not _many").select("_row.*")
    if not first.where("_many").limit(1).count():
        return single
    return single.unionByName(kept.where("_many").dropDuplicates(["_id", "_th"]).select("_row.*"))


def op3_jaccard(spark, sf_dir: str) -> DataFrame:
    """Distinct 3-word shingles, links where 100 * intersection >= 90 * union."""
    return jaccard_components(read_table(spark, sf_dir, "documents"), k=3, num=9, den=10)


QUERIES = {"op3_jaccard_join": op3_jaccard}

ORACLE = {"op3_jaccard_join": r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select doc_id, case when len(w) = 0 then []
                      when len(w) < 3 then [array_to_string(w, ' ')]
                      else list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) end as sh
  from d where w is not null),
t as (select doc_id, len(sh) as n, unnest(sh) as tok from s),
ov as (
  select a.doc_id as x, b.doc_id as y, a.n as nx, b.n as ny, count(*) as c
  from t a join t b on a.tok = b.tok and a.doc_id < b.doc_id
  where 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  group by all),
e as (select x, y from ov where 100 * c >= 90 * (nx + ny - c) union select y, x from ov where 100 * c >= 90 * (nx + ny - c)),
reach as (
  select doc_id as node, doc_id as seen from documents
  union
  select r.node, e.y from reach r join e on r.seen = e.x)
select documents.doc_id, cast(coalesce(len(s.sh), 0) as bigint) as n_shingles, c.component_id
from documents left join s using (doc_id)
join (select node as doc_id, min(seen) as component_id from reach group by node) c using (doc_id)
"""}
