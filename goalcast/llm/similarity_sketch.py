"""Near-duplicates by fast similarity sketching, banding and exact verification.

A sketch has ``t`` coordinates. In round ``i`` every shingle of a set is thrown into a bin with a
hash of that round, and a bin that is still empty keeps the smallest throw with its round. In
rounds ``0 .. t - 1`` the hash picks the bin; in rounds ``t .. 2 t - 1`` all shingles go to bin
``i - t``, so every coordinate is filled after ``2 t`` rounds at the latest, for sets of any size,
and a large set is done after about ``1 + t ln t / n`` rounds. Two coordinates agree with the
probability of the Jaccard similarity, with the concentration of ``t`` independent draws.

Sets that agree in all ``rows`` coordinates of one of the bands are compared on their full sets.
At similarity ``j`` a pair is missed with probability ``(1 - j ** rows) ** bands``: with 32 bands
of 5 rows below 1e-8 at 0.85 and 4e-6 at 0.8, for a pair that no chain of other links joins. Texts
of one class (equal sets) are never compared. A few bands come first: they find nearly all links
at little cost, and of all bands only those whose sets are not in one component yet are left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalcast.llm import packed
from goalcast.llm.families import family_components, linked
from goalcast.llm.shingles import class_id, full_sets, shingle_sets
from goalcast.llm.words import mix64
from goalcast.session import cut_lineage, read_table

U64 = np.uint64
#: Classes compared in one block of a family, rows of ids broadcast at most, shingles sketched at a time.
CHUNK, ID_LIMIT, SLICE = 256, 500_000, 1 << 18
#: Bands that are looked at before all are.
FIRST_BANDS = 6
_EMPTY = U64(0xFFFFFFFFFFFFFFFF)


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """Sketch of every (non-empty) set, one row of ``t`` coordinates each."""
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    out = np.full(len(sets) * t, _EMPTY, dtype=U64)
    live = np.flatnonzero(sizes > 0)
    tokens = np.concatenate([sets[i] for i in live]) if len(live) else np.zeros(0, U64)
    owner = np.repeat(live, sizes[live])
    for i in range(2 * t):
        if not len(tokens):
            break
        h = mix64(tokens ^ mix64(np.array([i + 1], dtype=U64) * U64(0x9E3779B97F4A7C15)))
        # the upper 16 bits pick the bin, the other 48 are the throw; the round ranks before them
        bins = ((h >> U64(48)) * U64(t) >> U64(16)).astype(np.int64) if i < t else np.full(len(h), i - t)
        value = (h & U64(0xFFFFFFFFFFFF)) | U64(i) << U64(48)
        # earlier rounds hold smaller values, so a filled bin keeps its throw
        np.minimum.at(out, owner * t + bins, value)
        done = np.zeros(len(sets), dtype=bool)
        done[live] = (out.reshape(-1, t)[live] != _EMPTY).all(axis=1)
        if done[live].any():
            keep = ~done[owner]
            tokens, owner = tokens[keep], owner[keep]
            live = live[~done[live]]
    return out.reshape(-1, t)


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` coordinates."""
    parts = sketch.reshape(len(sketch), -1, rows)
    key = np.zeros(parts.shape[:2], dtype=U64) + np.arange(parts.shape[1], dtype=U64)
    for r in range(rows):
        key = mix64(key * U64(0xD6E8FEB86659FD93) + parts[:, :, r])
    return key


def _sketch_rows(k: int, t: int, rows: int) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("rid", pa.int64()), ("n", pa.int64()), ("cid", pa.binary()),
                        ("bands", pa.list_(pa.int64()))])

    def flush(ids, held):
        sets = [x for _, x in held]
        keys = band_keys(sketches(sets, t), rows).view(np.int64)
        empty = [not len(x) for x in sets]
        lists = [None if e else key for e, key in zip(empty, keys)]
        return packed.batch(schema, [ids[0], ids[1], [r for r, _ in held], [len(x) for x in sets], [class_id(x) for x in sets], lists])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 31
        for b in batches:
            held, size, at = [], 0, 0
            for i, x in enumerate(shingle_sets(b.column(2), k)):
                held.append((rid, x))
                rid, size = rid + 1, size + len(x)
                if size >= SLICE or i + 1 == len(b):
                    yield flush([b.column(c).slice(at, len(held)) for c in (0, 1)], held)
                    at, held, size = i + 1, [], 0
    return run


def _verify(num: int, den: int) -> Callable:
    """Links among all pairs of a family whose sizes allow it."""
    def check(table: pa.Table, a: np.ndarray, b: np.ndarray, cand: np.ndarray) -> np.ndarray:
        sets = [np.frombuffer(x, dtype=U64) for x in table["tokens_all"].to_pylist()]
        n = np.array([len(x) for x in sets], dtype=np.int64)
        small, large = np.minimum.outer(n[a], n[b]), np.maximum.outer(n[a], n[b])
        return linked(sets, a, b, cand & (small * den >= large * num), num, den)
    return check


def _components(docs: DataFrame, k: int, num: int, den: int, bands: int, rows: int, id_limit: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``(doc_id, th, rid, n, cid)`` and, per class, ``(cid, least)``: the first row of its
    component by doc_id (nulls last)."""
    t = bands * rows
    packed.small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("th", F.xxhash64("text"))
    sets = cut_lineage(docs.select("doc_id", "th", "text").mapInArrow(
        packed.lean(_sketch_rows(k, t, rows)), "doc_id long, th long, rid long, n long, cid binary, bands array<long>"), "sketch-sets")
    classes = cut_lineage(sets.where("cid is not null").groupBy("cid").agg(
        F.min("rid").alias("rid"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", "rid")).alias("least")),
        "sketch-classes")

    full = roots = None
    # the bands of one row a class, written once: every read below would shuffle the bands of all rows again
    reps = cut_lineage(sets.join(classes.select("rid"), "rid", "left_semi").select("rid", "bands"), "sketch-reps")
    for n in (min(FIRST_BANDS, bands), bands):
        # one row per class and band; bands whose classes are one, or one component, leave
        own = reps.withColumn("label", F.col("rid"))
        if roots is not None:
            own = reps.join(roots.select(F.col("node").alias("rid"), "root"), "rid", "left").withColumn("label", F.coalesce("root", "rid"))
        entry = own.select("rid", "label", F.explode(F.slice("bands", 1, n)).alias("band"))
        shared = entry.groupBy("band").agg(F.min("rid").alias("leader"), F.min("label").alias("l"), F.max("label").alias("m")).where("l < m")
        shared = cut_lineage(shared.select("band", "leader"), "sketch-bands")
        side = F.broadcast(shared) if shared.count() <= id_limit else shared         # at most id_limit rows
        member = cut_lineage(entry.join(side, "band").select("leader", "rid").distinct(), "sketch-members")
        wanted = cut_lineage(sets.select("rid", "doc_id", "cid").join(member.select("rid").distinct(), "rid", "left_semi"), "sketch-wanted")
        if full is not None:
            wanted = wanted.join(full.select("rid"), "rid", "left_anti")
        more = full_sets(docs, wanted, k, id_limit, "sketch-full")
        full = more if full is None else full.unionByName(more)
        roots = family_components(member, lambda x: x.join(full, "rid"), _verify(num, den), CHUNK, "sketch", roots, first_only=n < bands)

    joined = roots.withColumnRenamed("node", "rid").join(classes, "rid")
    least = joined.groupBy("root").agg(F.min("least").alias("component"))
    joined = joined.join(least, "root").select("rid", "component")
    return sets.select("doc_id", "th", "rid", "n", "cid"), classes.join(joined, "rid", "left").select(
        "cid", F.coalesce("component", "least").alias("least"))


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, bands: int = 32, rows: int = 5,
                    id_limit: int = ID_LIMIT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, first)`` for every row of ``docs`` (columns doc_id, text;
    others are ignored): words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, sets of distinct
    ``k``-word shingles, links at Jaccard >= ``num / den``, each confirmed on the full sets. ``first``
    marks one row of every component (smallest doc_id), and every row without words.

    Defined cases: a null or wordless text has 0 shingles and links with nothing (its component
    is its own doc_id); a text of fewer than ``k`` words is one shingle; repeated doc_ids are
    judged row by row; a null doc_id is never a component id while another id is in reach;
    of rows alike in id and set one is first. An empty table gives an empty result."""
    rows_, classes = _components(docs, k, num, den, bands, rows, id_limit)
    alone = F.col("cid").isNull()
    return (rows_.join(classes, "cid", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
                    F.when(alone, True).otherwise(F.col("rid") == F.col("least.rid")).alias("first")))


def op11_sketch(spark, sf_dir: str) -> DataFrame:
    """Distinct 3-word shingles, links where 100 * intersection >= 85 * union."""
    out = near_duplicates(read_table(spark, sf_dir, "documents"), k=3, num=17, den=20)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


QUERIES = {"op11_minhash": op11_sketch}

ORACLE = {"op11_minhash": r"""
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
  where 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  group by all),
e as (select x, y from ov where 100 * c >= 85 * (nx + ny - c) union select y, x from ov where 100 * c >= 85 * (nx + ny - c)),
reach as (
  select doc_id as node, doc_id as seen from documents
  union
  select r.node, e.y from reach r join e on r.seen = e.x)
select documents.doc_id, cast(coalesce(len(s.sh), 0) as bigint) as n_shingles, c.component_id, documents.doc_id = c.component_id as kept
from documents left join s using (doc_id)
join (select node as doc_id, min(seen) as component_id from reach group by node) c using (doc_id)
"""}
