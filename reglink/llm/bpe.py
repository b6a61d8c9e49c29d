"""Byte-level BPE over public rank files: encoding and decoding.

A text is cut by the tokenizer's pattern and every match, the pre-token, is
encoded by itself in two tiers:

- a minimal perfect hash over the vocabulary resolves a pre-token that is a
  token as a whole. The hash is hash-and-displace: a key's bucket holds a
  displacement that sends all keys of the bucket to free places, so n tokens
  fill n places; buckets of one key name their place outright. The bytes at
  the place are compared, so a foreign pre-token is never taken for a token;
- any other pre-token starts as a linked list of its bytes. A heap holds the
  adjacent pairs that are tokens, lowest rank first and leftmost among equal
  ranks; entries whose pair has changed since are passed over when popped.

The distinct pre-tokens of a slice of texts are resolved once, the first tier
as array operations over all of them, and a worker remembers the misses it
has merged lately (``MEMORY``).

The vocabulary is read on the driver and broadcast; a rank file above
``MAX_VOCABULARY`` bytes is refused. Tokenizers are never trained here.

Null texts encode like empty ones: no ids, and they decode to no bytes. Null
ids, or ids that the vocabulary does not have, decode to null. Repeated rows
each give their row, empty tables give empty results, further columns are
passed over. Slices are about four megabytes; one very long text is a slice of
its own, and one very long pre-token needs memory in proportion to its
length.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reglink.llm import frames
from reglink.llm.text import Words, mix, slices

MAX_VOCABULARY = 1 << 26
MEMORY = 1 << 18
# Longer misses are merged each time instead of being remembered.
REMEMBERED_BYTES = 64
KEYS_PER_BUCKET = 4
TRIES = 256
# Bytes of text encoded, and ids decoded, at a time.
SLICE_BYTES = 1 << 22
SLICE_IDS = 1 << 18
FILE = "byte_bpe_50k.tiktoken"

# Two ids are one integer in the table of pairs.
_SHIFT = 31
_STEP = np.uint64(0xD1342543DE82EF95)


def _hashes(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of every (non-empty) binary string."""
    _, offsets, data = strings.cast(pa.large_binary()).buffers()
    offsets = np.frombuffer(offsets, np.int64)[: len(strings) + 1]
    raw = np.frombuffer(data, np.uint8)[: offsets[-1]] if len(strings) else np.empty(0, np.uint8)
    return Words(raw, np.ones(len(raw), bool), offsets, offsets[:-1], offsets[1:], np.arange(1)).hashes()


def _places(hashes: np.ndarray, displacement: np.ndarray, size: int) -> np.ndarray:
    """The place of each hash: named outright (negative) or displaced."""
    shifted = mix(hashes ^ (displacement.astype(np.uint64) * _STEP)) % np.uint64(size)
    return np.where(displacement < 0, -displacement - 1, shifted.astype(np.int64))


class PerfectHash:
    """Minimal perfect hash of distinct non-empty byte strings: ``find``
    gives each string's position among ``keys`` or -1."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.size, self.buckets = n, max(1, n // KEYS_PER_BUCKET)
        hashes = _hashes(pa.array(keys, pa.binary()))
        if len(np.unique(hashes)) != n:
            raise ValueError("two tokens share a 64-bit hash")
        bucket = self._bucket(hashes)
        members = np.argsort(bucket, kind="stable")
        ends = np.cumsum(np.bincount(bucket, minlength=self.buckets))
        self.displacement = np.zeros(self.buckets, np.int64)
        owner = np.full(n, -1, np.int64)
        groups = sorted((members[a:b] for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True) if b > a), key=len, reverse=True)
        for group in groups:
            if len(group) == 1:
                break
            self.displacement[bucket[group[0]]] = d = self._displace(hashes[group], owner)
            owner[_places(hashes[group], np.full(len(group), d), n)] = group
        alone = [g[0] for g in groups if len(g) == 1]
        free = np.flatnonzero(owner < 0)
        self.displacement[bucket[alone]] = -free - 1
        owner[free] = alone
        # The keys in the order of their places.
        self.owner, self.at = owner, [keys[i] for i in owner]

    def _bucket(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)

    @staticmethod
    def _displace(hashes: np.ndarray, owner: np.ndarray) -> int:
        """The least displacement that sends all hashes to different free places."""
        begin = 0
        while True:
            tried = np.arange(begin, begin + TRIES)
            places = np.sort(_places(hashes[None, :], np.repeat(tried[:, None], len(hashes), 1), len(owner)), axis=1)
            fits = (owner[places] < 0).all(axis=1) & (np.diff(places, axis=1) > 0).all(axis=1)
            if fits.any():
                return int(tried[np.argmax(fits)])
            begin += TRIES

    def find(self, strings: list[bytes]) -> np.ndarray:
        if not strings or not self.size:
            return np.full(len(strings), -1, np.int64)
        hashes = _hashes(pa.array(strings, pa.binary()))
        place = _places(hashes, self.displacement[self._bucket(hashes)], self.size)
        same = np.fromiter((self.at[p] == s for p, s in zip(place.tolist(), strings, strict=True)), bool, len(strings))
        return np.where(same, self.owner[place], -1)


def merge(piece: bytes, alone: list[int], pairs: dict[int, int]) -> tuple[int, ...]:
    """Ids of one pre-token: the adjacent pair of lowest rank merges first.
    ``alone`` has the id of each byte, ``pairs`` the id of each two ids that
    are a token together (the left one shifted by ``_SHIFT``)."""
    n, find, pop, push = len(piece), pairs.get, heapq.heappop, heapq.heappush
    # An entry is a rank and a place: small integers for short pieces.
    bits = 12 if n <= 4096 else 32
    mask = (1 << bits) - 1
    ids = [alone[b] for b in piece]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    # The entry of the pair that begins at a place now; any other one in the
    # heap is out of date.
    heap = [rank << bits | i for i, rank in enumerate([find(a << _SHIFT | b, -1) for a, b in zip(ids, ids[1:], strict=False)]) if rank >= 0]
    now = [-1] * n
    for entry in heap:
        now[entry & mask] = entry
    heapq.heapify(heap)
    while heap:
        entry = pop(heap)
        i = entry & mask
        if now[i] != entry:
            continue
        rank, gone = entry >> bits, after[i]
        ids[i], now[gone], now[i], after[i] = rank, -1, -1, (end := after[gone])
        if end < n:
            before[end] = i
            new = find(rank << _SHIFT | ids[end], -1)
            if new >= 0:
                now[i] = new = new << bits | i
                push(heap, new)
        if i:
            left = before[i]
            new = find(ids[left] << _SHIFT | rank, -1)
            if new >= 0:
                now[left] = new = new << bits | left
                push(heap, new)
            else:
                now[left] = -1
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    return tuple(out)


class Memory:
    """What a worker has merged lately: a young and an old generation of at
    most ``MEMORY`` pre-tokens each."""

    def __init__(self):
        self.young, self.old = {}, {}

    def get(self, piece: bytes) -> tuple[int, ...] | None:
        ids = self.young.get(piece)
        if ids is None and (ids := self.old.get(piece)) is not None:
            self.put(piece, ids)
        return ids

    def put(self, piece: bytes, ids: tuple[int, ...]) -> None:
        if len(self.young) >= MEMORY:
            self.young, self.old = {}, self.young
        self.young[piece] = ids


class Vocabulary:
    """Ranks and pattern of one tokenizer, with the perfect hash of its tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary has a rank for every byte")
        if len(set(ranks.values())) != len(ranks) or b"" in ranks or min(ranks.values()) < 0:
            raise ValueError("ranks have to be distinct, not negative, and of non-empty tokens")
        self.pattern, self.ranks = pattern, ranks
        if max(ranks.values()) >= 1 << _SHIFT:
            raise ValueError(f"ranks have to be below {1 << _SHIFT}")
        tokens = list(ranks)
        self.ids = np.array([ranks[t] for t in tokens], np.int32)
        self.hash = PerfectHash(tokens)
        # The bytes behind each id, one after the other; holes have none.
        self.known = np.zeros(int(self.ids.max()) + 1, bool)
        self.known[self.ids] = True
        by_id = dict(zip(self.ids.tolist(), tokens, strict=True))
        ordered = [by_id.get(i, b"") for i in range(len(self.known))]
        self.ends = np.cumsum([len(t) for t in ordered])
        self.raw = np.frombuffer(b"".join(ordered), np.uint8)
        self.alone = [ranks[bytes([b])] for b in range(256)]
        halves = [(left << _SHIFT | right, rank) for t, rank in ranks.items() for i in range(1, len(t)) if (left := ranks.get(t[:i])) is not None and (right := ranks.get(t[i:])) is not None]
        self._pairs = np.array(halves, np.int64).reshape(-1, 2)

    @cached_property
    def pairs(self) -> dict[int, int]:
        return dict(self._pairs.tolist())

    @cached_property
    def memory(self) -> Memory:
        """Shared by the tasks of one worker process."""
        return Memory()

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        """A rank file: a token in base64 and its rank on every line."""
        with open(path, "rb") as file:
            content = file.read(MAX_VOCABULARY + 1)
        if len(content) > MAX_VOCABULARY:
            raise ValueError(f"{path}: over {MAX_VOCABULARY} bytes, too large to broadcast")
        return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, content.splitlines()))}, pattern)

    def encode(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of distinct pre-tokens."""
        out, memory, alone, pairs = [], self.memory, self.alone, self.pairs
        whole = self.hash.find(pieces)
        for piece, id_ in zip(pieces, np.where(whole < 0, -1, self.ids[whole]).tolist(), strict=True):
            if id_ >= 0:
                out.append((id_,))
                continue
            ids = memory.get(piece)
            if ids is None:
                ids = merge(piece, alone, pairs)
                if len(piece) <= REMEMBERED_BYTES:
                    memory.put(piece, ids)
            out.append(ids)
        return out

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of known ids, and how many each has."""
        ends = self.ends[ids]
        return _gather(self.raw, np.where(ids > 0, self.ends[ids - 1], 0), ends)


def _gather(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values[start:end] of all ranges, one after the other, and their sizes."""
    sizes = ends - starts
    shift = starts - (np.cumsum(sizes) - sizes)
    return values[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))], sizes


def _offsets(sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where the rows' elements begin and end: row i has the ranges rows[i]:rows[i + 1]."""
    return np.concatenate([[0], np.cumsum(sizes)])[rows]


def _id_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``SLICE_IDS`` ids, at least one row each."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy().astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + SLICE_IDS, "right")))
        yield batch.slice(begin, stop - begin)
        begin = stop


def _encode(vocabulary: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        voc = vocabulary.value
        cut = regex.compile(voc.pattern).findall
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                found = [cut(text) if text else [] for text in part.column("text").to_pylist()]
                rows = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
                pieces = pa.chunked_array([pa.array(x, pa.string()) for x in found]).combine_chunks().dictionary_encode()
                ids = voc.encode(pieces.dictionary.cast(pa.binary()).to_pylist())
                ends = np.cumsum([len(x) for x in ids])
                which = pieces.indices.to_numpy()
                flat, sizes = _gather(np.fromiter(chain.from_iterable(ids), np.int32), np.concatenate([[0], ends[:-1]]).astype(np.int64)[which], ends[which]) if len(which) else (np.empty(0, np.int32), np.empty(0, np.int64))
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.ListArray.from_arrays(pa.array(_offsets(sizes, rows), pa.int32()), pa.array(flat))], names=["key", "ids"])

    return run


def _decode(vocabulary: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary.value
        for batch in batches:
            for part in _id_slices(batch):
                lists = part.column("ids")
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
                rows = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
                values = lists.flatten()
                ids = values.fill_null(-1).to_numpy().astype(np.int64)
                bad = (ids < 0) | (ids >= len(voc.known))
                bad[~bad] = ~voc.known[ids[~bad]]
                raw, sizes = voc.decode(np.where(bad, voc.ids[0], ids).astype(np.int64)) if len(ids) else (np.empty(0, np.uint8), np.empty(0, np.int64))
                missing = np.diff(np.concatenate([[0], np.cumsum(bad)])[rows]) > 0
                missing |= lists.is_null().to_numpy(zero_copy_only=False)
                text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(_offsets(sizes, rows).astype(np.int64)), pa.py_buffer(raw.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("key"), lists, pc.if_else(pa.array(missing), pa.scalar(None, pa.binary()), text)], names=["key", "ids", "decoded"])

    return run


def share(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """The vocabulary of a rank file, for ``encode`` and ``decode``."""
    frames.ready(spark)
    return spark.sparkContext.broadcast(Vocabulary.load(path, pattern))


def encode(docs: DataFrame, vocabulary: Broadcast, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) of every row, without special tokens."""
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return source.mapInArrow(_encode(vocabulary), f"key {source.schema['key'].dataType.simpleString()}, ids array<int>")


def decode(tokens: DataFrame, vocabulary: Broadcast, key: str = "key", ids: str = "ids") -> DataFrame:
    """(key, ids, decoded): the bytes behind the ids of every row."""
    source = tokens.select(F.col(f"`{key}`").alias("key"), F.col(f"`{ids}`").cast("array<int>").alias("ids"))
    return source.mapInArrow(_decode(vocabulary), f"key {source.schema['key'].dataType.simpleString()}, ids array<int>, decoded binary")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and their decoded bytes, as digests."""
    import public_tokenizers

    vocabulary = share(spark, public_tokenizers.path(FILE), public_tokenizers.PATTERN)
    out = decode(encode(frames.read(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return out.select(
        F.col("key").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
