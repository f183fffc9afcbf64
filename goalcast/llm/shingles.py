"""Shingle sets of texts, and the full sets of chosen classes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalcast.llm import packed
from goalcast.llm.words import SPACED, gram_hashes, hashed_words, mix64
from goalcast.session import cut_lineage

U64 = np.uint64


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    for i, j, words, counts in hashed_words(texts, SPACED, lower=True):
        grams, at = gram_hashes(words, k), 0
        for c in counts:
            if c >= k:
                yield np.unique(grams[at:at + c - k + 1])
            elif c:
                yield mix64(gram_hashes(words[at:at + c], int(c)) + U64(k))
            else:
                yield np.zeros(0, U64)
            at += c


def class_id(tokens: np.ndarray) -> bytes | None:
    """Names the class of all texts with this set; null for the empty set."""
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


def _full_sets(k: int) -> Callable:
    schema = pa.schema([("rid", pa.int64()), ("tokens_all", pa.binary())])

    def run(batches):
        for b in batches:
            rids, out = [], []
            for rid, cid, x in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), shingle_sets(b.column(0), k)):
                if len(x) and class_id(x) == cid:
                    rids.append(rid)
                    out.append(x.tobytes())
            yield packed.batch(schema, [rids, out])
    return run


def full_sets(docs: DataFrame, classes: DataFrame, k: int, id_limit: int, name: str, more: DataFrame | None = None) -> DataFrame:
    """``(rid, tokens_all)`` of ``classes`` (rid, doc_id, cid), read again from the texts of
    ``docs`` (doc_id, text); classes are broadcast up to ``id_limit`` rows, about 110 bytes each. Rows
    of one id and set give a class more than once; only then are the sets shuffled, once, to keep one.
    The columns of ``more`` (one row a rid) are joined to the sets before they are written: later
    joins with some rows then move those rows' sets alone."""
    picked = classes.select("rid", F.col("doc_id").alias("_id"), "cid")
    if picked.count() <= id_limit:
        picked = F.broadcast(picked)                           # at most id_limit rows
    text = docs.join(picked, docs["doc_id"].eqNullSafe(F.col("_id"))).select("text", "rid", "cid")
    full = text.mapInArrow(packed.lean(_full_sets(k)), "rid long, tokens_all binary")
    if more is not None:
        return cut_lineage(full.dropDuplicates(["rid"]).join(more, "rid"), name)
    full = cut_lineage(full, name)
    if full.groupBy("rid").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return full
    return cut_lineage(full.dropDuplicates(["rid"]), f"{name}-once")
