"""Removal of long word passages that another document already holds (seed and extend).

Every window of ``span`` words is assigned to its winnowed anchor: the smallest of its
``seed``-word gram hashes (leftmost on ties), so equal windows have the same anchor at the same
place. Consecutive windows with one anchor form a unit - the anchor extended both ways as far as
it stays the winnowing choice. The corpus join runs in two steps, both on packed hashes with
partial aggregation before the shuffle:

1. anchors join units: per anchor the distinct units, each with its smallest document. A unit
   that a smaller document holds in full goes as a whole.
2. only where an anchor has several different units (the matches end inside them) the first
   holders of these units compare single windows, so matches end at the exact word.

Overlapping windows of a document merge into its maximal repeats. A passage that a third of all
documents share is one row per task before the shuffle and looked up in salted groups after it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalcast.llm import packed
from goalcast.llm.words import SPACED, gram_hashes, hashed_words, mix64
from goalcast.session import cut_lineage, read_table

U64 = np.uint64
ID_LIMIT = 500_000
_B = 0xB5297A4D3F84D5B5
_BASE, _INVERSE = U64(_B), U64(pow(_B, -1, 1 << 64))
_PLACE = U64((1 << 24) - 1)
_STARTS = 1 << 22


def _powers(base: U64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Spans:
    """Hashes of any span of a word-hash array, from prefix sums of a polynomial."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.sums = np.concatenate([np.zeros(1, U64), np.add.accumulate(words * _powers(_BASE, n))]) if n else np.zeros(1, U64)
        self.back = _powers(_INVERSE, n + 1)

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[begin]) * self.back[begin] + (end - begin).astype(U64))


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values (doubling)."""
    size, m = 1, x
    while size * 2 <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    rest = w - size
    return np.minimum(m[:-rest], m[rest:]) if rest else m


def _units(words: np.ndarray, counts: np.ndarray, span: int, seed: int):
    """(document, first window, last window, anchor, content) of every unit of some documents."""
    empty = np.zeros(0, np.int64)
    if len(words) < span:
        return empty, empty, empty, np.zeros(0, U64), np.zeros(0, U64)
    ends = np.cumsum(counts)
    begins = ends - counts
    hashes, out = _Spans(words), []
    for lo in range(0, len(words) - span + 1, _STARTS):       # bounded runs of window starts
        hi = min(lo + _STARTS, len(words) - span + 1)
        grams = gram_hashes(words[lo:hi + span - 1], seed)
        key = (grams & ~_PLACE) | np.arange(len(grams), dtype=U64)
        best = (_sliding_min(key, span - seed + 1) & _PLACE).astype(np.int64)
        start = np.arange(lo, hi)
        doc = np.searchsorted(ends, start, side="right")
        ok = start + span <= ends[doc]
        new = ok.copy()
        new[1:] &= ~ok[:-1] | (best[1:] != best[:-1])
        first = np.flatnonzero(new)
        last = np.flatnonzero(ok & np.append(new[1:] | ~ok[1:], True))
        a, b = start[first], start[last]
        out.append((doc[first], a - begins[doc[first]], b - begins[doc[first]], grams[best[first]], hashes(a, b + span)))
    return tuple(np.concatenate(x) for x in zip(*out))


_UNITS = "rid long, doc_id long, th long, n_words long, sha string, anchor binary, unit binary, lo binary, hi binary"


def _unit_rows(span: int, seed: int) -> Callable:
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()), ("n_words", pa.int64()),
                        ("sha", pa.string()), *[(c, pa.binary()) for c in ("anchor", "unit", "lo", "hi")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 32
        for b in batches:
            rows = []
            ids, ths = b.column(0).to_pylist(), b.column(1).to_pylist()
            texts = b.column(2).cast(pa.binary()).fill_null(b"").to_pylist()
            for i, j, words, counts in hashed_words(b.column(2), SPACED, lower=False):
                doc, lo, hi, anchor, unit = _units(words, counts, span, seed)
                cut = np.searchsorted(doc, np.arange(j - i + 1))
                for d in range(j - i):
                    part = slice(cut[d], cut[d + 1])
                    rows.append((rid, ids[i + d], ths[i + d], int(counts[d]),
                                 hashlib.sha256(b" ".join(texts[i + d].split())).hexdigest(),
                                 anchor[part].tobytes(), unit[part].tobytes(),
                                 lo[part].astype(np.uint32).tobytes(), hi[part].astype(np.uint32).tobytes()))
                    rid += 1
            yield packed.rows(schema, rows)
    return run


def _gathered(batches: Iterator[pa.RecordBatch], columns: dict) -> Iterator[dict]:
    """Bounded blocks of the packed columns of documents with an id, with rid and doc_id per value."""
    def flush():
        sizes = [len(x) for x in parts[first]]
        out = {c: np.concatenate(v) for c, v in parts.items()}
        return out | {"rid": np.repeat(np.array(rids, np.int64), sizes), "doc_id": np.repeat(np.array(ids, np.int64), sizes)}
    first = next(iter(columns))
    parts, rids, ids, held = {c: [] for c in columns}, [], [], 0
    for b in batches:
        for row in b.to_pylist():
            if row["doc_id"] is None or not row[first]:
                continue
            if held >= packed.BLOCK // 2:
                yield flush()
                parts, rids, ids, held = {c: [] for c in columns}, [], [], 0
            for c, kind in columns.items():
                parts[c].append(np.frombuffer(row[c], dtype=kind))
            rids.append(row["rid"])
            ids.append(row["doc_id"])
            held += len(parts[first][-1])
    if rids:
        yield flush()


_SEEN = "bucket int, low binary, unit binary, doc binary, n long"


def _extremes(keys: list[np.ndarray], doc: np.ndarray):
    """Distinct keys with their smallest and largest document (keys: most significant last)."""
    order = np.lexsort((doc, *keys))
    keys, doc = [k[order] for k in keys], doc[order]
    new = np.zeros(len(doc), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return [k[first] for k in keys], doc[first], doc[last]


def _send_units(buckets: int) -> Callable:
    schema = pa.schema([("bucket", pa.int32()), ("low", pa.binary()), ("unit", pa.binary()), ("doc", pa.binary()), ("n", pa.int64())])

    def run(batches):
        for x in _gathered(batches, {"anchor": U64, "unit": U64}):
            sizes = {b: len(k) for b, k in packed.split_by_bucket(x["anchor"], buckets)}
            (unit, anchor), least, most = _extremes([x["unit"], x["anchor"]], x["doc_id"])
            more = most > least                                # a second row tells that several documents hold it
            anchor, unit, doc = (np.concatenate(p) for p in ((anchor, anchor[more]), (unit, unit[more]), (least, most[more])))
            yield packed.rows(schema, [(b, packed.low32(k), u.tobytes(), d.tobytes(), sizes[b])
                                       for b, k, u, d in packed.split_by_bucket(anchor, buckets, unit, doc)])
    return run


def _first_holders(table: pa.Table) -> pa.Table:
    """Units of anchors that several documents hold: smallest document, and whether the anchor has other units."""
    low, unit, doc = (packed.joined(table[c], k) for c, k in (("low", np.uint32), ("unit", U64), ("doc", np.int64)))
    (unit, low), least, most = _extremes([unit, low], doc)
    group = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    sizes = np.diff(np.append(group, len(low)))
    shared = np.repeat(np.maximum.reduceat(most, group) > np.minimum.reduceat(least, group), sizes)
    mixed = np.repeat(sizes > 1, sizes)
    return pa.table({"bucket": pa.array([table["bucket"][0].as_py()], pa.int32()),
                     **{c: pa.array([v[shared].tobytes()], pa.binary())
                        for c, v in (("low", low), ("unit", unit), ("doc", least), ("mixed", mixed))},
                     "total": pa.array([sum(table["n"].to_pylist())], pa.int64())})


def _send_occurrences(buckets: int, salts: np.ndarray) -> Callable:
    schema = pa.schema([("bucket", pa.int32()), ("salt", pa.int32()), *[(c, pa.binary()) for c in ("low", "unit", "rid", "doc", "lo", "hi")]])

    def run(batches):
        salt = TaskContext.get().partitionId()
        for x in _gathered(batches, {"anchor": U64, "unit": U64, "lo": np.uint32, "hi": np.uint32}):
            salt += 1
            yield packed.rows(schema, [(b, salt % int(salts[b]), packed.low32(k), *[v.tobytes() for v in more])
                                       for b, k, *more in packed.split_by_bucket(
                                           x["anchor"], buckets, x["unit"], x["rid"], x["doc_id"], x["lo"], x["hi"])])
    return run


def _judge_units(here: pa.Table, known: pa.Table) -> pa.Table:
    """Window ranges that go as a whole, and ranges whose windows must be compared one by one."""
    out = {"rid": np.zeros(0, np.int64), "lo": np.zeros(0, np.int32), "hi": np.zeros(0, np.int32), "whole": np.zeros(0, bool)}
    if here.num_rows and known.num_rows:
        low, unit, rid, doc, lo, hi = (packed.joined(here[c], k) for c, k in (
            ("low", np.uint32), ("unit", U64), ("rid", np.int64), ("doc", np.int64), ("lo", np.uint32), ("hi", np.uint32)))
        klow, kunit, kdoc, mixed = (packed.joined(known[c], k) for c, k in (
            ("low", np.uint32), ("unit", U64), ("doc", np.int64), ("mixed", np.bool_)))
        if len(kunit):
            # a unit's hash covers its anchor, so it is looked up alone
            order = np.argsort(kunit, kind="stable")
            at = order[np.minimum(np.searchsorted(kunit[order], unit), len(kunit) - 1)]
            hit = (kunit[at] == unit) & (klow[at] == low)
            whole, part = hit & (kdoc[at] < doc), hit & mixed[at] & (kdoc[at] == doc)
            keep = whole | part
            out = {"rid": rid[keep], "lo": lo[keep].astype(np.int32), "hi": hi[keep].astype(np.int32), "whole": whole[keep]}
    return pa.table(out)


def _windows(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[tuple]:
    """(hash, rid, doc_id, start) of the windows to compare, in bounded blocks."""
    parts, held = [], 0
    for b in batches:
        rids, ids, ranges = (b.column(c).to_pylist() for c in ("rid", "doc_id", "ranges"))
        for i, j, words, counts in hashed_words(b.column(b.schema.get_field_index("text")), SPACED, lower=False):
            hashes, begin = _Spans(words), 0
            for d in range(j - i):
                for r in ranges[i + d]:
                    start = np.arange(r["lo"], r["hi"] + 1)
                    parts.append((hashes(begin + start, begin + start + span), np.full(len(start), rids[i + d]),
                                  np.full(len(start), ids[i + d]), start))
                    held += len(start)
                begin += int(counts[d])
            if held >= packed.BLOCK // 2:
                yield tuple(np.concatenate(x) for x in zip(*parts))
                parts, held = [], 0
    if parts:
        yield tuple(np.concatenate(x) for x in zip(*parts))


def _send_windows(buckets: int, span: int) -> Callable:
    schema = pa.schema([("bucket", pa.int32()), ("unit", pa.binary()), ("doc", pa.binary()), ("n", pa.int64())])

    def run(batches):
        for key, _, doc, _ in _windows(batches, span):
            sizes = {b: len(k) for b, k in packed.split_by_bucket(key, buckets)}
            (key,), least, most = _extremes([key], doc)
            more = most > least
            key, doc = np.concatenate((key, key[more])), np.concatenate((least, most[more]))
            yield packed.rows(schema, [(b, k.tobytes(), d.tobytes(), sizes[b]) for b, k, d in packed.split_by_bucket(key, buckets, doc)])
    return run


def _first_windows(table: pa.Table) -> pa.Table:
    key, doc = packed.joined(table["unit"], U64), packed.joined(table["doc"], np.int64)
    (key,), least, most = _extremes([key], doc)
    keep = most > least
    return pa.table({"bucket": pa.array([table["bucket"][0].as_py()], pa.int32()),
                     "unit": pa.array([key[keep].tobytes()], pa.binary()), "doc": pa.array([least[keep].tobytes()], pa.binary()),
                     "total": pa.array([sum(table["n"].to_pylist())], pa.int64())})


def _send_starts(buckets: int, span: int, salts: np.ndarray) -> Callable:
    schema = pa.schema([("bucket", pa.int32()), ("salt", pa.int32()), *[(c, pa.binary()) for c in ("unit", "rid", "doc", "lo")]])

    def run(batches):
        salt = TaskContext.get().partitionId()
        for key, rid, doc, start in _windows(batches, span):
            salt += 1
            yield packed.rows(schema, [(b, salt % int(salts[b]), k.tobytes(), *[v.tobytes() for v in more])
                                       for b, k, *more in packed.split_by_bucket(key, buckets, rid, doc, start.astype(np.uint32))])
    return run


def _judge_windows(here: pa.Table, known: pa.Table) -> pa.Table:
    out = {"rid": np.zeros(0, np.int64), "lo": np.zeros(0, np.int32), "hi": np.zeros(0, np.int32)}
    if here.num_rows and known.num_rows:
        key, rid, doc, lo = (packed.joined(here[c], k) for c, k in (("unit", U64), ("rid", np.int64), ("doc", np.int64), ("lo", np.uint32)))
        kkey, kdoc = packed.joined(known["unit"], U64), packed.joined(known["doc"], np.int64)
        if len(kkey):
            at = np.minimum(np.searchsorted(kkey, key), len(kkey) - 1)
            hit = (kkey[at] == key) & (kdoc[at] < doc)
            out = {"rid": rid[hit], "lo": lo[hit].astype(np.int32), "hi": lo[hit].astype(np.int32)}
    return pa.table(out)


def _cut(span: int) -> Callable:
    schema = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("n_removed", pa.int64()), ("kept_sha", pa.string()), ("kept", pa.string())])

    def run(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                words = r["text"].encode().split()
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for x in r["ranges"]:
                    gone[x["lo"]] += 1
                    gone[min(x["hi"] + span, len(words))] -= 1
                keep = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
                text = b" ".join([words[i] for i in keep])
                rows.append((r["doc_id"], r["th"], len(words) - len(keep), hashlib.sha256(text).hexdigest(), text.decode()))
            yield packed.rows(schema, rows)
    return run


def find_repeats(docs: DataFrame, span: int = 50, seed: int = 20, id_limit: int = ID_LIMIT) -> tuple[DataFrame, DataFrame]:
    """``(all rows, changed rows)``: ``(doc_id, th, n_words, sha)`` of every row of ``docs`` and
    ``(_id, _th, n_removed, kept_sha, kept)`` of the documents that lose words, one row per
    (doc_id, ``xxhash64(text)`` as th)."""
    spark = docs.sparkSession
    packed.small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("th", F.xxhash64("text"))
    units = cut_lineage(docs.select("doc_id", "th", "text").mapInArrow(packed.lean(_unit_rows(span, seed)), _UNITS), "repeat-units")
    size = units.agg(F.sum(F.octet_length("unit") / 8)).collect()[0][0]       # one row
    buckets = packed.bucket_count(spark, int(size or 0))
    known = cut_lineage(units.select("rid", "doc_id", "anchor", "unit").mapInArrow(packed.lean(_send_units(buckets)), _SEEN)
                        .groupBy("bucket").applyInArrow(_first_holders, "bucket int, low binary, unit binary, doc binary, mixed binary, total long"),
                        "repeat-holders")
    salt = F.explode(F.expr(f"sequence(0, {packed.salts_of('total')} - 1)"))
    found = cut_lineage(
        units.select("rid", "doc_id", "anchor", "unit", "lo", "hi")
        .mapInArrow(packed.lean(_send_occurrences(buckets, packed.bucket_salts(known, buckets))), "bucket int, salt int, low binary, unit binary, rid binary, doc binary, lo binary, hi binary")
        .groupBy("bucket", "salt").cogroup(known.withColumn("salt", salt).drop("total").groupBy("bucket", "salt"))
        .applyInArrow(_judge_units, "rid long, lo int, hi int, whole boolean"), "repeat-found")

    # texts of the documents with such ranges; equal rows need one of them
    marked = found.select("rid").distinct()
    ids = (units.select("rid", F.col("doc_id").alias("_id"), F.col("th").alias("_th")).join(marked, "rid")
           .groupBy("_id", "_th").agg(F.min("rid").alias("rid")))
    ids = cut_lineage(ids, "repeat-ids")
    side = F.broadcast(ids) if ids.count() <= id_limit else ids   # at most id_limit rows
    texts = cut_lineage(docs.join(side, (docs["doc_id"] == F.col("_id")) & (docs["th"] == F.col("_th")))
                        .select("rid", "doc_id", "th", "text"), "repeat-texts")

    part = found.where("not whole").groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    compare = texts.join(part, "rid")
    size = found.where("not whole").agg(F.sum(F.col("hi") - F.col("lo") + 1)).collect()[0][0]   # one row
    buckets = packed.bucket_count(spark, int(size or 0))
    first = cut_lineage(compare.mapInArrow(packed.lean(_send_windows(buckets, span)), "bucket int, unit binary, doc binary, n long")
                        .groupBy("bucket").applyInArrow(_first_windows, "bucket int, unit binary, doc binary, total long"), "repeat-windows")
    single = (compare.mapInArrow(packed.lean(_send_starts(buckets, span, packed.bucket_salts(first, buckets))), "bucket int, salt int, unit binary, rid binary, doc binary, lo binary")
              .groupBy("bucket", "salt").cogroup(first.withColumn("salt", salt).drop("total").groupBy("bucket", "salt"))
              .applyInArrow(_judge_windows, "rid long, lo int, hi int"))
    gone = (found.where("whole").select("rid", "lo", "hi").unionByName(single)
            .groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")))
    changed = cut_lineage(texts.join(gone, "rid").select("doc_id", "th", "text", "ranges")
                          .mapInArrow(packed.lean(_cut(span)), "_id long, _th long, n_removed long, kept_sha string, kept string")
                          .dropDuplicates(["_id", "_th"]), "repeat-changed")
    return units.select("doc_id", "th", "n_words", "sha"), changed


def remove_repeats(docs: DataFrame, span: int = 50, seed: int = 20) -> DataFrame:
    """``docs`` with every word dropped that lies in a window of ``span`` words whose sequence
    also starts in a document with a smaller doc_id; a text that loses words becomes its kept
    words joined by one space (and ``n_chars``, if there, its length), other texts and all other
    columns stay as they are."""
    _, changed = find_repeats(docs, span, seed)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_doc"),
                       F.xxhash64(F.col("text").cast("string")).alias("_key"))
    kept = changed.select("_id", "_th", F.col("kept").alias("_kept"))
    out = rows.join(kept, (F.col("_doc") == F.col("_id")) & (F.col("_key") == F.col("_th")), "left")
    replaced = {"text": F.coalesce("_kept", "_row.text")}
    if "n_chars" in docs.columns:
        replaced["n_chars"] = F.coalesce(F.char_length("_kept").cast("long"), "_row.n_chars")
    return out.select(*[replaced.get(c, F.col(f"_row.{c}")).alias(c) for c in docs.columns])


def repeat_digest(docs: DataFrame, span: int = 50, seed: int = 20) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` for every row of ``docs`` (doc_id, text;
    other columns are ignored). Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; windows are
    judged on the input. Exact up to 64-bit hash collisions.

    Defined cases: a null or short text has no window and loses nothing (the digest of no words
    is that of the empty string); rows with one doc_id never cost each other words; a row with
    a null doc_id neither loses words nor costs others any; an empty table gives no rows.
    """
    rows, changed = find_repeats(docs, span, seed)
    return (rows.join(changed.drop("kept"), (F.col("doc_id") == F.col("_id")) & (F.col("th") == F.col("_th")), "left")
            .select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("kept_sha", "sha").alias("kept_sha256")))


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Windows of 50 words, seeds of 20 words."""
    return repeat_digest(read_table(spark, sf_dir, "documents"), span=50, seed=20)


QUERIES = {"op4_substring_dedup": op4_substring_dedup}

ORACLE = {"op4_substring_dedup": r"""
with d as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
win as (
  select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as h
  from d, unnest(range(1, greatest(len(w) - 48, 1))) as t(i)),
least_doc as (select h, min(doc_id) as m from win group by h),
gone as (
  select distinct win.doc_id, i + o as p from win join least_doc using (h), range(50) as r(o) where m < win.doc_id),
words as (select doc_id, generate_subscripts(w, 1) as p, unnest(w) as x from d),
kept as (
  select words.doc_id, string_agg(x, ' ' order by words.p) as s, count(*) as n
  from words left join gone on words.doc_id = gone.doc_id and words.p = gone.p
  where gone.p is null group by words.doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(s, '')) as kept_sha256
from d left join kept using (doc_id)
"""}
