"""Language identification by Viterbi over per-word scores.

A word is a run of letters and marks. Its script (fixed code point ranges) narrows the candidate
languages to those seen in that script during training; its score in each is a naive Bayes sum
over hashed character trigrams. A Viterbi pass with a switching penalty then labels every word,
so text in several languages falls into spans; a document's language is the one whose spans hold
most letters. Training counts trigrams of a bounded hash-chosen sample of rows per language;
prediction reads whole texts, all documents of a slice advancing together word by word.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goalcast.llm import packed
from goalcast.session import cut_lineage, read_table

U64 = np.uint64
BUCKETS = 1 << 15
#: Training rows per language at most; log-odds to switch language.
PER_LANGUAGE, SWITCH = 1500, 8.0
#: Characters of texts that advance together, characters scored in one go (about 60 bytes each).
SLICE, PIECE = 1 << 21, 1 << 18
#: Score of a language that does not write the word's script.
BARRED = np.float32(-60.0)

#: Code point ranges of scripts (script 1 is every other letter).
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F)],
}
N_SCRIPTS = len(SCRIPTS) + 2


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(script of word characters or 0, is a letter, lower case) for every code point."""
    kinds = [unicodedata.category(chr(c)) for c in range(0x110000)]
    letter = np.array([k[0] == "L" for k in kinds])
    script = np.array([k[0] in "LM" for k in kinds]).astype(np.uint8)
    for number, ranges in enumerate(SCRIPTS.values(), start=2):
        for lo, hi in ranges:
            script[lo:hi + 1][script[lo:hi + 1] > 0] = number
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in np.flatnonzero(letter).tolist():
        low = chr(c).lower()
        if len(low) == 1:
            lower[c] = ord(low)
    return script, letter, lower


def _grams(texts: list[str]):
    """Trigram buckets of the words of some texts: (buckets, first bucket of each word, script of
    each word, letters of each word, words of each text)."""
    script, letter, lower = _characters()
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
    kind = script[chars]
    inside = kind > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.cumsum(sizes) - sizes
    begin_of_text = starts[starts < len(chars)]
    first[begin_of_text] = inside[begin_of_text]
    at = np.flatnonzero(inside)
    begin = np.flatnonzero(first[at])
    words_of = np.diff(np.searchsorted(at[begin], np.append(starts, len(chars)), side="left"))
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none, words_of
    length = np.diff(np.append(begin, len(at)))
    # every word is followed by one end mark (0), which also parts it from the next
    end = begin + length + np.arange(len(begin))               # places of the end marks
    c = np.zeros(len(at) + len(begin), dtype=U64)
    keep = np.ones(len(c), dtype=bool)
    keep[end] = False
    c[keep] = lower[chars[at]]
    one, two = np.zeros_like(c), np.zeros_like(c)
    one[1:] = c[:-1]
    two[2:] = c[:-2]
    head = begin + np.arange(len(begin))
    two[head] = 0                                              # the character before the last word's end mark
    key = two * U64(0x9E3779B97F4A7C15) + one * U64(0xC2B2AE3D27D4EB4F) + c * U64(0x165667B19E3779F9)
    key = (key ^ (key >> U64(29))) * U64(0xBF58476D1CE4E5B9)
    letters = np.add.reduceat(letter[chars[at]].astype(np.int64), begin)
    return (key >> U64(49)).astype(np.int64), head, kind[at[begin]].astype(np.int64), letters, words_of


def _held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("slot", pa.int32()), ("cnt", pa.int64())])
    for b in batches:
        rows, langs, texts = [], b.column(0).to_pylist(), b.column(1).to_pylist()
        for lang in sorted(set(langs)):
            for part in _slices([p for t, x in zip(texts, langs) if x == lang for p in _pieces(t)], PIECE):
                buckets, _, scripts, _, _ = _grams(part)
                for kind, values, size in ((0, buckets, BUCKETS), (1, scripts, N_SCRIPTS)):
                    counts = np.bincount(values, minlength=size)
                    rows += [(lang, kind, int(s), int(counts[s])) for s in np.flatnonzero(counts)]
        yield packed.rows(schema, rows)


def _slices(texts: list[str], limit: int | None = None) -> Iterator[list[str]]:
    """Consecutive texts of about ``limit`` characters together (a longer text stands alone)."""
    limit = limit or SLICE
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > limit:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces of at most ``PIECE`` characters, cut at white space; a word that is
    longer than that is cut like a text."""
    at = 0
    while len(text) - at > PIECE:
        cut = at + PIECE
        back = next((c for c in range(cut, cut - 1000, -1) if text[c].isspace()), cut)
        yield text[at:back]
        at = back
    yield text[at:]


class LanguageModel:
    """Trigram log-probabilities per language, and the scripts each language is written in."""

    def __init__(self, rows: list[tuple[str, int, int, int]]):
        self.langs = sorted({r[0] for r in rows})
        index = {x: i for i, x in enumerate(self.langs)}
        counts = np.zeros((len(index), BUCKETS))
        written = np.zeros((len(index), N_SCRIPTS))
        for lang, kind, slot, cnt in rows:
            (written if kind else counts)[index[lang], slot] += cnt
        self.log = np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)).astype(np.float32)
        share = written / np.maximum(written.sum(axis=1, keepdims=True), 1)
        self.uses = share >= 0.01                              # language x script


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Fit on rows that are not held out and have a language and a text; of each language the
    ``per_language`` rows with the smallest id hash (a documented bound: the model is at most
    languages x ``BUCKETS`` counts)."""
    packed.small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "lang", F.col("text").cast("string").alias("text"))
    rows = (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~_held_out())
            .select(F.col("doc_id").cast("long").alias("_id"), F.col("lang").alias("_lang"), F.xxhash64("doc_id").alias("h")).distinct())
    # hash ranges of each language up to the one that fills the bound, then its exact rank
    rows = rows.withColumn("range", F.shiftrightunsigned("h", 48))
    ranges = rows.groupBy("_lang", "range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("_lang").orderBy("range")) - F.col("n")
    ranges = ranges.withColumn("before", before).where(f"before < {per_language}").select("_lang", "range")
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy("range", "h", "_id"))
    near = (rows.join(F.broadcast(ranges), ["_lang", "range"])     # at most per_language ranges a language
            .withColumn("r", rank).where(f"r <= {per_language}"))
    chosen = F.broadcast(cut_lineage(near.select("_id", "_lang"), "langid-sample"))   # per_language rows a language
    counted = (docs.join(chosen, (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")))
               .where(F.col("text").isNotNull()).select("lang", "text")
               .mapInArrow(packed.lean(_count_grams), "lang string, kind int, slot int, cnt long")
               .groupBy("lang", "kind", "slot").agg(F.sum("cnt").alias("cnt")))
    return LanguageModel([tuple(r) for r in counted.collect()])   # at most languages x (BUCKETS + scripts) rows


def _viterbi(scores: np.ndarray, words_of: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word; the documents' words follow each other in ``scores``."""
    label = np.zeros(len(scores), dtype=np.int16)
    docs = np.argsort(-words_of, kind="stable")
    docs = docs[words_of[docs] > 0]
    if not len(docs):
        return label
    length, start = words_of[docs], (np.cumsum(words_of) - words_of)[docs]
    active = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")    # documents with more than t words
    switched = np.zeros(scores.shape, dtype=bool)
    best_before = np.zeros(len(scores), dtype=np.int16)
    v = scores[start].copy()
    for t in range(1, int(length[0])):
        a = active[t]
        at = start[:a] + t
        old = v[:a]
        top = old.argmax(axis=1)
        jump = old[np.arange(a), top][:, None] - penalty
        better = old < jump
        switched[at], best_before[at] = better, top
        v[:a] = np.where(better, jump, old) + scores[at]
    state = v.argmax(axis=1)
    label[start + length - 1] = state
    for t in range(int(length[0]) - 1, 0, -1):
        a = active[t]
        at = start[:a] + t
        s = state[:a]
        state[:a] = np.where(switched[at, s], best_before[at], s)
        label[at - 1] = state[:a]
    return label


def _label(model: LanguageModel, penalty: float) -> Callable[[list[str]], list[tuple]]:
    """``(language, share of its letters, spans, share of the letters in words of a script that a
    learned language writes)`` of each of some texts."""
    n = len(model.langs)

    def score(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(scores of each word, letters of each word, the same in learned scripts, words of each text)."""
        buckets, head, scripts, letters, words_of = _grams(texts)
        scores, learned = np.zeros((len(head), n), dtype=np.float32), np.zeros_like(letters)
        if len(head) and n:
            for x in range(n):
                scores[:, x] = np.add.reduceat(model.log[x][buckets], head)
            may = model.uses.T[scripts]                        # word x language
            known = may.any(axis=1)
            scores[~known] = 0                                 # a script that no language writes says nothing
            scores[known[:, None] & ~may] += BARRED
            learned = letters * known
        return scores, letters, learned, words_of

    def label(texts: list[str]) -> list[tuple]:
        cut = [list(_pieces(t)) for t in texts]
        scored = [score(part) for part in _slices([p for c in cut for p in c], PIECE)]
        scores, letters, learned, counts = (np.concatenate(x) for x in zip(*scored))
        words_of = np.add.reduceat(counts, np.cumsum([0] + [len(c) for c in cut[:-1]]))
        labels = _viterbi(scores, words_of, penalty) if n else np.zeros(len(scores), np.int16)
        weight, out, at = letters.astype(np.float64), [], 0
        for w in words_of:
            part, mass = labels[at:at + w], weight[at:at + w]
            total = mass.sum()
            if not total or not n:
                out.append(("und", 0.0, [], 0.0))
            else:
                share = np.bincount(part, weights=mass, minlength=n)
                top = int(share.argmax())
                cut = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
                size = np.diff(np.append(cut, w))
                out.append((model.langs[top], float(share[top] / total),
                            [{"lang": model.langs[part[c]], "first_word": int(c), "n_words": int(z)} for c, z in zip(cut, size)],
                            float(learned[at:at + w].sum() / total)))
            at += w
        return out
    return label


def _predict(model: LanguageModel, penalty: float) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()),
                        ("spans", pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())])))])
    label = _label(model, penalty)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [r for part in _slices(b.column(2).fill_null("").to_pylist()) for r in label(part)]
            yield packed.batch(schema, [b.column(0), b.column(1), *([r[i] for r in out] for i in range(3))])
    return run


def identify_language(docs: DataFrame, model: LanguageModel | None = None, penalty: float = SWITCH) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, spans)`` for every row of ``docs`` (doc_id, text,
    lang; others are ignored; lang only trains). ``score`` is the share of letters in spans of
    the predicted language; ``spans`` are runs of words with one label.

    Defined cases: a null text or one without letters is ``und`` with score 0 and no spans, and
    so is every text when no row can train; a word in a script that no learned language writes
    takes its neighbours' label; ties go to the alphabetically first language; a null doc_id
    never trains and is not held out; repeated rows are predicted one by one; an empty table
    gives no rows.
    """
    model = model or train(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _held_out().alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(packed.lean(_predict(model, penalty)), "doc_id long, held_out boolean, lang_pred string, score double, "
                           "spans array<struct<lang: string, first_word: long, n_words: long>>")


def keep_identified(docs: DataFrame, least_share: float = 0.5, penalty: float = SWITCH) -> DataFrame:
    """``docs`` without the rows that have no language: ``und``, or less than ``least_share`` of the
    letters in words of scripts that a learned language writes. A text in several learned languages
    stays. All columns and kept rows stay as they are. If there is no row to learn from, nothing can
    be judged and all rows stay."""
    model = train(docs)
    if not model.langs:
        return docs
    label = _label(model, penalty)

    @F.arrow_udf("boolean")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = [r for part in _slices(texts.fill_null("").to_pylist()) for r in label(part)]
            yield pa.array([lang != "und" and learned >= least_share for lang, _, _, learned in out], pa.bool_())
        packed.give_back()
    return docs.where(judge(F.col("text").cast("string")))


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    return (identify_language(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans")))


QUERIES = {"op9_language_id": op9_language_id}
