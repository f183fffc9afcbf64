"""Periodic runs of words by a dictionary of basic factors.

For every power of two ``m`` the factors of ``m`` words get names (equal factors, equal names),
built from pairs of names of half the length. The next occurrence of a factor at a distance ``d``
with ``m <= d < 2 m`` proposes the period ``d``. In a run of period ``q`` and three periods or
more, some factor of ``m > q / 2`` words occurs once a period (a word of smallest period ``q`` has
at least ``min(q, m + 1)`` distinct cyclic factors), so the true period is always proposed, by a
position of its first period. Proposals of one period that lie at most a period apart form an
arithmetic progression of one run; its core is extended both ways and judged.

Names take the document into account, so many documents share one dictionary and factors match
inside a document only. Memory follows the words of a slice (a long document is one slice):
two names and a sort of the repeated factors, whatever the number of levels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalcast.llm import packed
from goalcast.session import read_table

#: Words of a slice of documents.
SLICE_WORDS = 1 << 17
#: Extension steps by names before words are compared.
NAME_STEPS = 32

_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _name(keys: np.ndarray) -> np.ndarray:
    """Names of the keys that occur twice or more; -1 for the others."""
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    repeated = counts > 1
    names = np.where(repeated, np.cumsum(repeated) - 1, -1)
    return names[inverse].astype(np.int64)


def _matches(x: np.ndarray, t: int, d: int) -> int:
    """Length of the longest stretch from ``t`` on where words ``d`` apart are equal."""
    total, size = 0, 64
    while True:
        right = x[t + d + total:t + d + total + size]
        wrong = np.flatnonzero(x[t + total:t + total + len(right)] != right)
        if len(wrong):
            return total + int(wrong[0])
        total += len(right)
        if len(right) < size:
            return total
        size *= 2


def _matches_back(x: np.ndarray, t: int, d: int) -> int:
    """Length of the longest stretch that ends before ``t`` where words ``d`` apart are equal."""
    total, size = 0, 64
    while True:
        lo = max(0, t - total - size)
        left = x[lo:t - total]
        wrong = np.flatnonzero(left != x[lo + d:t - total + d])
        if len(wrong):
            return total + len(left) - 1 - int(wrong[-1])
        total += len(left)
        if len(left) < size:
            return total
        size *= 2


def _steps(names: np.ndarray, t: np.ndarray, d: np.ndarray, m: int, sign: int) -> np.ndarray:
    """Whole factors that agree from ``t`` on (``sign`` 1), or before ``t`` (-1): a lower bound of
    the extension, at most ``NAME_STEPS`` factors."""
    done, at = np.zeros(len(t), dtype=np.int64), t.copy()
    if sign < 0:
        at = at - m
    live = np.arange(len(t))
    for _ in range(NAME_STEPS):
        live = live[(at[live] >= 0) & (at[live] + d[live] < len(names))]
        a = names[at[live]]
        live = live[(a >= 0) & (a == names[at[live] + d[live]])]
        if not len(live):
            break
        done[live] += m
        at[live] += sign * m
    return done


def find_runs(x: np.ndarray, longest: int, least: int, periods: int) -> np.ndarray:
    """Rows ``(start, length, period)`` of all runs of ``x`` (word ids that differ between
    documents; the longest document has ``longest`` words) with ``length >= max(least, periods *
    period)``, in order of start and period; ``periods`` is 3 or more."""
    found, m, names = [], 1, _name(x)
    while m * periods <= longest:
        at = np.flatnonzero(names >= 0)
        if not len(at):
            break
        p = at[np.argsort(names[at], kind="stable")]
        d = np.diff(p)
        near = (names[p[1:]] == names[p[:-1]]) & (d >= m) & (d < 2 * m)
        i, d = p[:-1][near], d[near]
        # two names cover the period: the proposal must repeat as a whole
        j = i + d - m
        inside = j + d < len(x)
        i, d, j = i[inside], d[inside], j[inside]
        square = (names[j] >= 0) & (names[j] == names[j + d])
        i, d = i[square], d[square]
        if len(i):
            order = np.lexsort((i, d))
            i, d = i[order], d[order]
            first = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (i[1:] - i[:-1] > d[1:])))
            lo, hi, d = i[first], i[np.append(first[1:], len(i)) - 1], d[first]
            reach = hi + 2 * d - lo + _steps(names, hi + d, d, m, 1) + _steps(names, lo, d, m, -1)
            for a, b, q in zip(*(v[reach + 2 * (m - 1) >= np.maximum(least, periods * d)].tolist() for v in (lo, hi, d))):
                start = a - _matches_back(x, a, q)
                end = b + 2 * q + _matches(x, b + q, q)
                if end - start >= max(least, periods * q):
                    found.append((start, end - start, q))
        # factors of twice the length repeat only where both halves do
        i = at[at + m < len(names)]
        i = i[names[i + m] >= 0]
        pairs = _name(names[i] * np.int64(names.max() + 1) + names[i + m])
        names = np.full(len(names), -1, dtype=np.int64)
        names[i] = pairs
        m *= 2
    return np.array(sorted(set(found)), dtype=np.int64).reshape(-1, 3)


def _slices(texts: list[str | None]) -> Iterator[list[list[bytes]]]:
    """Words of consecutive texts, about ``SLICE_WORDS`` at a time."""
    held, size = [], 0
    for t in texts:
        words = (t or "").encode().split()                     # bytes split at \x20 and \x09-\x0D only
        if held and size + len(words) > SLICE_WORDS:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def _judge(docs: list[list[bytes]], least: int, periods: int) -> Iterator[tuple[list[dict], str]]:
    """Runs and collapsed text of each document of a slice."""
    counts = np.array([len(w) for w in docs], dtype=np.int64)
    begin = np.append(0, np.cumsum(counts))
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for words in docs for w in words), dtype=np.int64, count=int(begin[-1]))
    x = ids + np.repeat(np.arange(len(docs)), counts) * max(1, len(known))
    runs = find_runs(x, int(counts.max(initial=0)), least, periods)
    owner = np.searchsorted(begin, runs[:, 0], side="right") - 1
    cuts = np.searchsorted(owner, np.arange(len(docs) + 1))
    for k, words in enumerate(docs):
        mine = []
        if cuts[k] < cuts[k + 1]:
            keep = np.ones(len(words), dtype=bool)
            for start, length, period in runs[cuts[k]:cuts[k + 1]].tolist():
                start -= int(begin[k])
                mine.append({"start": start, "length": length, "period": period})
                keep[start + period:start + length] = False
            words = [words[i] for i in np.flatnonzero(keep)]
        yield mine, b" ".join(words).decode()


def _task(least: int, periods: int) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("runs", _RUN), ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for docs in _slices(b.column(1).to_pylist()):
                runs, texts = zip(*_judge(docs, least, periods))
                yield packed.batch(schema, [b.column(0).slice(at, len(docs)), list(runs), list(texts)])
                at += len(docs)
    return run


def periodic_runs(docs: DataFrame, least: int = 24, periods: int = 3) -> DataFrame:
    """``(doc_id, runs, collapsed)`` for every row of ``docs`` (columns doc_id, text; others are
    ignored). Words are ``[^\\x20\\x09-\\x0D]+``. ``runs`` holds (start, length, period) of every
    maximal stretch of smallest period ``period`` and at least ``max(least, periods * period)``
    words, by start and period; ``collapsed`` is the text without the words of a run after its
    first period, joined by one space.

    Defined cases: a null, empty or wordless text has no runs and an empty collapsed text;
    repeated rows and ids, null ids included, are judged row by row; overlapping runs each drop
    their own words; an empty table gives an empty result. ``periods`` below 3 is refused,
    because then a period need not be proposed."""
    if periods < 3:
        raise ValueError("a run has at least three periods")
    packed.small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(packed.lean(_task(least, periods)),
                           "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` where a tenth of the documents, chosen by the crc32 of the decimal id,
    repeats its words from some place on; a null id is never chosen."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
            .withColumn("w", F.expr(r"if(h % 10 = 0, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0), null)"))
            .withColumn("n", F.size("w"))
            .withColumn("a", F.expr("if(n > 0, (h div 10) % n, null)"))
            .withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)"))
            .select("doc_id", F.expr("if(n > 0, array_join(transform(sequence(0L, n - 1L), "
                                     "i -> w[int(if(i < a, i, a + (i - a) % p))]), ' '), text)").alias("text")))


def op12_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of 24 words and three periods or more, over the texts with planted runs."""
    out = periodic_runs(with_planted_runs(read_table(spark, sf_dir, "documents")), least=24, periods=3)
    # runs come by start and period, so the first of equal exponents stays
    best = F.expr("aggregate(runs, runs[0], (m, r) -> if(r.length * m.period > m.length * r.period, r, m))")
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return (out.withColumn("best", F.when(F.size("runs") > 0, best))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                    F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(F.expr(lines).cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


QUERIES = {"op12_periodic_runs": op12_runs}
