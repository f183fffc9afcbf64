"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A word is the leaf row of a tree: leaf ``i`` holds the rank of the pair that starts at symbol
``i`` (with its place in the low bits, so equal ranks resolve to the left), every node the
minimum of its children. The root is the next merge; a merge changes three leaves and their
paths, so a word of ``n`` symbols takes ``O(n log n)`` steps however long it is. Words of similar
length share one set of numpy arrays and advance together; long words take the same steps alone.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalcast.llm import packed
from goalcast.session import read_table

#: White space as the tokenizer's patterns know it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Chunks that a worker remembers, characters encoded in one go, longest word of the joint trees.
CACHE, SEGMENT, JOINT = 300_000, 1 << 20, 256
NONE = np.int64(1) << 62


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: Latin-1
    characters that print stand for themselves, the others follow from U+0100 on."""
    own = [33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 for b in range(256)]
    return [chr(b) if own[b] else chr(256 + b - sum(own[:b])) for b in range(256)]


class ByteBPE:
    """Encoder and decoder of one byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        symbols = byte_symbols()
        self.of_byte = np.array([vocab[c] for c in symbols], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left, right = (np.array([vocab[p[x]] for p in pairs], dtype=np.int64) for x in (0, 1))
        self.product = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.width = np.int64(len(vocab) + len(spec["added_tokens"]) + 1)
        keys = left * self.width + right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.rank = dict(zip(keys.tolist(), range(len(keys))))
        back = {c: b for b, c in enumerate(symbols)}
        self.bytes_of = {i: bytes(back[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.chunks = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.known: dict[str, bytes] = {}

    # ---- segment trees -------------------------------------------------------------

    def _leaves(self, a: np.ndarray, b: np.ndarray, place: np.ndarray) -> np.ndarray:
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, (self.order[at] << 32) | place, NONE)

    def _joint(self, words: list[bytes], size: int) -> list[bytes]:
        """Words of at most ``size`` bytes (a power of two), one tree row each."""
        n, lengths = len(words), np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(size, b"\0") for w in words), dtype=np.uint8).reshape(n, size)
        ids = self.of_byte[raw]
        alive = np.arange(size) < lengths[:, None]
        after = np.broadcast_to(np.arange(1, size + 1), (n, size)).copy()
        before = np.broadcast_to(np.arange(-1, size - 1), (n, size)).copy()
        tree = np.full((n, 2 * size), NONE, dtype=np.int64)
        pair = alive[:, 1:]
        r, i = np.nonzero(pair)
        tree[r, size + i] = self._leaves(ids[r, i], ids[r, i + 1], i)
        node = size
        while node > 1:
            tree[:, node // 2:node] = np.minimum(tree[:, node:2 * node:2], tree[:, node + 1:2 * node:2])
            node //= 2
        rows = np.arange(n)
        while True:
            root = tree[rows, 1]
            rows = rows[root < NONE]
            if not len(rows):
                break
            root = root[root < NONE]
            i = root & np.int64(0xFFFFFFFF)
            j = after[rows, i]
            k = after[rows, j]
            ids[rows, i] = self.product[root >> 32]
            alive[rows, j] = False
            after[rows, i] = k
            tree[rows, size + j] = NONE
            tree[rows, size + i] = NONE
            right = k < lengths[rows]
            rr, ri, rk = rows[right], i[right], k[right]
            before[rr, rk] = ri
            tree[rr, size + ri] = self._leaves(ids[rr, ri], ids[rr, rk], ri)
            h = before[rows, i]
            left = h >= 0
            lr, lh, li = rows[left], h[left], i[left]
            tree[lr, size + lh] = self._leaves(ids[lr, lh], ids[lr, li], lh)
            who, node = np.concatenate([rows, rows, lr]), np.concatenate([i, j, lh]) + size
            while size > 1 and node[0] > 1:
                node >>= 1
                tree[who, node] = np.minimum(tree[who, 2 * node], tree[who, 2 * node + 1])
        flat, counts = ids[alive].astype("<u4").tobytes(), 4 * alive.sum(axis=1)
        ends = np.cumsum(counts)
        return [flat[e - c:e] for e, c in zip(ends.tolist(), counts.tolist())]

    def _alone(self, word: bytes) -> bytes:
        """The same steps for one long word."""
        n = len(word)
        size = 1 << (n - 1).bit_length()
        none, rank, width = int(NONE), self.rank, int(self.width)
        ids = self.of_byte[np.frombuffer(word, dtype=np.uint8)]
        leaves = np.full(size, NONE, dtype=np.int64)
        leaves[:n - 1] = self._leaves(ids[:-1], ids[1:], np.arange(n - 1))
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
        tree = [none] + np.concatenate(levels[::-1]).tolist()
        ids, product = ids.tolist(), self.product.tolist()
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(b"\1" * n)

        def put(place: int, value: int) -> None:
            node = size + place
            tree[node] = value
            while node > 1:
                node >>= 1
                a, b = tree[2 * node], tree[2 * node + 1]
                least = a if a < b else b
                if tree[node] == least:
                    break
                tree[node] = least

        def value(place: int, a: int, b: int) -> int:
            found = rank.get(a * width + b)
            return none if found is None else (found << 32) | place

        while tree[1] < none:
            i, r = tree[1] & 0xFFFFFFFF, tree[1] >> 32
            j = after[i]
            k = after[j]
            ids[i], after[i], alive[j] = product[r], k, 0
            put(j, none)
            if k < n:
                before[k] = i
                put(i, value(i, ids[i], ids[k]))
            else:
                put(i, none)
            h = before[i]
            if h >= 0:
                put(h, value(h, ids[h], ids[i]))
        return np.array(ids)[np.frombuffer(bytes(alive), dtype=np.bool_)].astype("<u4").tobytes()

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word (no splitting), as little-endian unsigned 32-bit bytes."""
        out: list[bytes] = [b""] * len(words)
        sizes: dict[int, list[int]] = {}
        for at, w in enumerate(words):
            if len(w) > JOINT:
                out[at] = self._alone(w)
            elif w:
                sizes.setdefault(max(2, 1 << (len(w) - 1).bit_length()), []).append(at)
        for size, places in sizes.items():
            step = max(1, (1 << 19) // size)                   # bounded arrays
            for lo in range(0, len(places), step):
                part = places[lo:lo + step]
                for at, ids in zip(part, self._joint([words[x] for x in part], size)):
                    out[at] = ids
        return out

    # ---- texts ---------------------------------------------------------------------

    def _learn(self, chunks: set[str]) -> dict[str, bytes]:
        split = {c: [w.encode() for w in self.words.findall(c)] for c in chunks}
        words = list({w for ws in split.values() for w in ws})
        ids = dict(zip(words, self.encode_words(words)))
        return {c: b"".join([ids[w] for w in ws]) for c, ws in split.items()}

    def _chunks(self, texts: list[list[str]]) -> list[bytes]:
        known = self.known
        fresh = self._learn({c for t in texts for c in t if c not in known})
        if len(known) + len(fresh) <= CACHE:
            known.update(fresh)
            look = known.__getitem__
        else:
            look = lambda c: fresh[c] if c in fresh else known[c]
        return [b"".join(map(look, t)) for t in texts]

    def _plain(self, text: str) -> bytes:
        """A text without special tokens, a bounded run of chunks at a time."""
        found, out = (m.group() for m in self.chunks.finditer(text)), []
        while run := list(islice(found, SEGMENT // 8)):
            out += self._chunks([run])
        return b"".join(out)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        group, size = [], 0
        for t in texts:
            odd = len(t) > SEGMENT or (self.split_special and self.split_special.search(t))
            if group and (odd or size + len(t) > SEGMENT):
                yield from self._chunks([self.chunks.findall(x) for x in group])
                group, size = [], 0
            if odd:
                parts = self.split_special.split(t) if self.split_special else [t]
                yield b"".join(self.special[p].to_bytes(4, "little") if p in self.special else self._plain(p) for p in parts)
            else:
                group.append(t)
                size += len(t)
        yield from self._chunks([self.chunks.findall(x) for x in group])

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the decoded ids; broken characters become U+FFFD, as the library does."""
        raw, of = [], self.bytes_of
        numbers = np.frombuffer(ids, dtype="<u4")
        for lo in range(0, len(numbers), SEGMENT):
            raw.append(b"".join([of[i] for i in numbers[lo:lo + SEGMENT].tolist()]))
        return b"".join(raw).decode("utf-8", errors="replace").encode()


@lru_cache(maxsize=2)
def _loaded(path: str) -> ByteBPE:
    return ByteBPE(path)


def _digests(path: str) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(path)
        for b in batches:
            rows = [(doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest())
                    for doc_id, ids in zip(b.column(0).to_pylist(), bpe.encode(b.column(1).fill_null("").to_pylist()))]
            yield packed.rows(schema, rows)
    return run


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` plus ``ids``: the token ids of ``text`` (array<long>; a null text has none)."""
    @F.pandas_udf("array<long>")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(x, dtype="<u4").astype(np.int64) for x in _loaded(tokenizer).encode(texts.fillna("").tolist())])
    return docs.withColumn("ids", ids(F.col("text").cast("string")))


def decode_ids(df: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` plus the text of its token ids (a null list is an empty text)."""
    @F.pandas_udf("string")
    def back(lists: pd.Series) -> pd.Series:
        return pd.Series([_loaded(tokenizer).decode(np.array([] if x is None else x, dtype="<u4").tobytes()).decode() for x in lists])
    return df.withColumn(text, back(ids))


def bpe_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every row of ``docs``.

    ``tokenizer`` is the path of a byte-level BPE file that every executor can open. A null or
    empty text has no ids (digests of nothing); special tokens standing in a text are matched
    first, as the library does; null and repeated doc_ids pass through, other columns are
    ignored, an empty table gives no rows. Nothing is shuffled.
    """
    packed.small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(packed.lean(_digests(tokenizer)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_bpe(spark, sf_dir: str) -> DataFrame:
    """The public byte-level BPE over every document."""
    import public_tokenizers
    return bpe_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op10_bpe": op10_bpe}
