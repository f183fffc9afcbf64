"""Bounded-space online packing of tokenised documents into fixed-length sequences.

Each task tokenises its documents and keeps a fixed number of open windows. Full-length pieces
of long documents are sequences of their own; what remains goes to the open window that it fits
best (least room left). When none fits, the fullest window is sealed and a new one opened. The
windows still open at the end of a task meet those of a fixed number of other tasks and are
merged best-fit, largest first. Only piece records (a few numbers) leave a task, never ids.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalcast.llm import packed
from goalcast.llm.words import BYTE_TABLE, run_hashes
from goalcast.session import cut_lineage, read_table

#: Words whose ids a worker remembers (about 50 bytes each), characters looked at in one go.
CACHE, SEGMENT = 300_000, 1 << 18

# White space, letters, numbers and contractions of Latin-1 as the tokenizer's
# patterns see them.
SPACES = bytes([*range(0x09, 0x0E), 0x20, 0x85, 0xA0])
LETTERS = bytes([*range(0x41, 0x5B), *range(0x61, 0x7B), 0xAA, 0xB5, 0xBA, *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])
NUMBERS = bytes([*range(0x30, 0x3A), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE])
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")

SPACE, LETTER, NUMBER, OTHER = range(4)
KIND = np.full(256, OTHER, dtype=np.uint8)
for _kind, _bytes in ((SPACE, SPACES), (LETTER, LETTERS), (NUMBER, NUMBERS)):
    KIND[list(_bytes)] = _kind
LOWER = bytes(ord(chr(b).lower()) if b in LETTERS else b for b in range(256))


class HashTable:
    """Open addressing over arrays: 64-bit keys (not 0) to places, whole arrays at a time."""

    def __init__(self, bits: int = 16):
        self.keys, self.values, self.size = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32), 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of every key, -1 where there is none."""
        out, left = np.full(len(keys), -1, np.int32), np.arange(len(keys))
        slot = (keys & np.uint64(len(self.keys) - 1)).astype(np.int64)
        while len(left):
            there = self.keys[slot]
            hit = there == keys[left]
            out[left[hit]] = self.values[slot[hit]]
            on = ~hit & (there != 0)
            left, slot = left[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that are not there yet."""
        if 2 * (self.size + len(keys)) > len(self.keys):
            full = self.keys != 0
            old = self.keys[full], self.values[full]
            self.__init__(max(len(self.keys).bit_length(), (4 * (self.size + len(keys))).bit_length()))
            self.add(*old)
        self.size += len(keys)
        slot = (keys & np.uint64(len(self.keys) - 1)).astype(np.int64)
        while len(keys):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[free]                 # of several in one slot, one stays
            won = free & (self.keys[slot] == keys)
            self.values[slot[won]] = values[won]
            keys, values, slot = keys[~won], values[~won], (slot[~won] + 1) & (len(self.keys) - 1)


class WordEncoder:
    """Token ids of whole texts, as arrays of unsigned 32-bit numbers.

    For Latin-1 text the tokenizer's normaliser and pattern come down to lower-casing and cutting
    by byte kinds, so words are cut and hashed here for many texts at once; every distinct word
    is encoded once (without normaliser and pattern) and remembered under its 64-bit hash, and
    a text's ids are gathered from the table of words. Any other text, and one that holds a
    special token, goes to the tokenizer whole; so does every text if the tokenizer file is of
    another make.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        spec["truncation"] = spec["padding"] = None
        self.load_whole = functools.cache(lambda: Tokenizer.from_file(path))   # most texts never need it
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.by_word = steps == ["NFC", "Replace", "Lowercase"] and len(cuts) == 2 and cuts[1]["type"] == "ByteLevel"
        if self.by_word:
            self.gap = re.compile(b"[" + re.escape(SPACES) + b"]")
            self.word = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": cuts[1]}))
        self.places, self.table, self.ends = HashTable(), np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _latin(self, text: str) -> bytes | None:
        """Lower-cased Latin-1 bytes of a text that can be cut here."""
        if not self.by_word or self.special.search(text):
            return None
        try:
            return text.encode("latin-1").translate(LOWER)
        except UnicodeEncodeError:
            return None

    def _segments(self, text: bytes) -> Iterator[bytes]:
        """A text in bounded pieces cut at white space."""
        at = 0
        while len(text) - at > SEGMENT:
            cut = self.gap.search(text, at + SEGMENT)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.end()
        yield text[at:]

    @staticmethod
    def _word_starts(raw: np.ndarray, kind: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where words begin: runs of letters, single numbers, runs of other characters, and the
        contractions (an apostrophe that no run of others has taken, and its letters)."""
        first = kind != SPACE
        first[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        first[starts] = kind[starts] != SPACE
        mark = np.flatnonzero((raw == 0x27) & first)
        if len(mark):
            ends = np.append(starts, len(raw))[np.searchsorted(starts, mark, side="right")]
            done = np.zeros(len(mark), dtype=bool)
            padded = np.concatenate([raw, np.zeros(3, np.uint8)])
            for tail in CONTRACTIONS:                          # in the pattern's order
                hit = ~done & (mark + len(tail) < ends)
                for x, b in enumerate(tail, start=1):
                    hit &= padded[mark + x] == b
                done |= hit
                after = mark[hit] + len(tail) + 1
                first[mark[hit] + 1] = False
                on = after[after < ends[hit]]
                first[on] |= kind[on] == LETTER                # what is left of the word
        return first

    def _encode_latin(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of lower-cased texts of together about ``SEGMENT`` bytes."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
        starts = np.cumsum(sizes) - sizes
        kind = KIND[raw]
        hashes, at, lengths = run_hashes(raw, kind != SPACE, self._word_starts(raw, kind, starts[starts < len(raw)]), BYTE_TABLE)
        hashes |= np.uint64(1)                                 # 0 is the free key
        place = self.places.find(hashes)
        table, ends = self.table, self.ends
        missing = np.flatnonzero(place < 0)
        if len(missing):
            fresh, one, of = np.unique(hashes[missing], return_index=True, return_inverse=True)
            one = missing[one]
            data = raw.tobytes()
            words = [data[a:a + n].decode("latin-1") for a, n in zip(at[one].tolist(), lengths[one].tolist())]
            new = [e.ids for e in self.word.encode_batch_fast(words, add_special_tokens=False)]
            numbers = np.arange(len(ends) - 1, len(ends) - 1 + len(fresh), dtype=np.int32)
            place[missing] = numbers[of]
            table = np.concatenate([table, np.array(list(chain.from_iterable(new)), dtype=np.uint32)])
            ends = np.concatenate([ends, ends[-1] + np.cumsum([len(ids) for ids in new])])
            if len(ends) <= CACHE:
                self.places.add(fresh, numbers)
                self.table, self.ends = table, ends
        low, count = ends[place], ends[place + 1] - ends[place]
        total = np.cumsum(count)
        ids = table[np.arange(total[-1] if len(total) else 0) + np.repeat(low - (total - count), count)]
        stops = np.concatenate([np.zeros(1, np.int64), total])[np.searchsorted(at, starts + sizes)]
        return np.split(ids, stops[:-1])

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, a bounded group of texts at a time."""
        group: list[bytes] = []
        size = 0
        for t in texts:
            latin = self._latin(t)
            if group and (latin is None or size + len(latin) > SEGMENT):
                yield from self._encode_latin(group)
                group, size = [], 0
            if latin is None:
                whole = self.load_whole()
                whole.no_truncation()
                whole.no_padding()
                yield np.array(whole.encode_batch_fast([t], add_special_tokens=False)[0].ids, dtype=np.uint32)
            elif len(latin) > SEGMENT:
                yield np.concatenate([x for s in self._segments(latin) for x in self._encode_latin([s])])
            else:
                group.append(latin)
                size += len(latin)
        if group:
            yield from self._encode_latin(group)


class OpenWindows:
    """A fixed number of open windows with best-fit placing."""

    def __init__(self, length: int, limit: int, first_id: int):
        self.length, self.limit, self.next_id = length, limit, first_id
        self.room: list[tuple[int, int]] = []                  # (room left, window), sorted
        self.parts: dict[int, list] = {}

    def place(self, piece: tuple, size: int) -> list[tuple[int, list]]:
        """Place a piece; returns the windows sealed by that."""
        sealed, at = [], bisect_left(self.room, (size, -1))
        if size < self.length and at < len(self.room):
            room, w = self.room.pop(at)
        else:
            if size < self.length and len(self.room) >= self.limit:
                _, fullest = self.room.pop(0)
                sealed.append((fullest, self.parts.pop(fullest)))
            room, w = self.length, self.next_id
            self.next_id += 1
            self.parts[w] = []
        self.parts[w].append(piece)
        if room > size:
            insort(self.room, (room - size, w))
        else:
            sealed.append((w, self.parts.pop(w)))
        return sealed


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, window long, place long, used long, open boolean"


def _pack(path: str, end_id: int, length: int, limit: int) -> Callable:
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "window", "place", "used")]
                       + [("open", pa.bool_())])
    end = np.uint32(end_id)

    def rows(window: tuple[int, list], is_open: bool) -> list[tuple]:
        w, parts = window
        used, out, at = sum(p[2] for p in parts), [], 0
        for p in parts:
            out.append((*p, w, at, used, is_open))
            at += p[2]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        windows = OpenWindows(length, limit, TaskContext.get().partitionId() << 32)
        for b in batches:
            out = []
            texts = b.column(1).fill_null("").to_pylist()
            for doc_id, ids in zip(b.column(0).to_pylist(), encoder.encode(texts)):
                ids = np.append(ids, end).astype("<u4")
                total, view = len(ids), memoryview(ids).cast("B")
                for start in range(0, total, length):
                    size = min(length, total - start)
                    piece = (doc_id, start, size, zlib.crc32(view[4 * start:4 * (start + size)]), total)
                    for w in windows.place(piece, size):
                        out += rows(w, False)
            if out:
                yield packed.rows(schema, out)
        yield packed.rows(schema, [r for w in windows.parts.items() for r in rows(w, True)])
    return run


def _merge(length: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        """Leftover windows of a few tasks, largest first, each into the fullest window that takes it."""
        used = dict(zip(table["window"].to_pylist(), table["used"].to_pylist()))
        room: list[tuple[int, int]] = []
        base, target = {}, {}
        for w in sorted(used, key=lambda w: (-used[w], w)):
            at = bisect_left(room, (used[w], -1))
            left, into = room.pop(at) if at < len(room) else (length, w)
            target[w], base[w] = into, length - left
            insort(room, (left - used[w], into))
        windows = table["window"].to_pylist()
        place = [p + base[w] for p, w in zip(table["place"].to_pylist(), windows)]
        return (table.set_column(table.schema.get_field_index("window"), "window", pa.array([target[w] for w in windows], pa.int64()))
                .set_column(table.schema.get_field_index("place"), "place", pa.array(place, pa.int64())))
    return run


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = 2048,
                   open_windows: int = 64, fan_in: int = 64) -> DataFrame:
    """One row per piece: ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    ``tokenizer`` is the path of a tokenizer file that every executor can open. A document is
    its text's ids and then ``end_id``; it is cut only at multiples of ``length``. A sequence
    holds at most ``length`` ids, its pieces one after the other from offset 0; at most
    ``fan_in * open_windows`` leftover windows meet in a merge task.

    Defined cases: a null or empty text is ``end_id`` alone; null and repeated doc_ids are packed
    row by row like others; other columns are ignored; an empty table gives no rows.
    """
    packed.small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = cut_lineage(docs.mapInArrow(packed.lean(_pack(tokenizer, end_id, length, open_windows)), _PIECES), "pack-pieces")
    merged = (pieces.where("open").groupBy(F.expr(f"(window >> 32) div {fan_in}"))
              .applyInArrow(_merge(length), _PIECES))
    return (pieces.where("not open").unionByName(merged)
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    F.col("window").alias("sequence_id"), F.col("place").alias("offset")))


def op6_packing(spark, sf_dir: str) -> DataFrame:
    """Sequences of 2048 ids of the public word BPE, 64 open windows a task."""
    import public_tokenizers
    return pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op6_packing": op6_packing}
