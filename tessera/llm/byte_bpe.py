"""Byte-level BPE by a two-tier lookup, and decoding.

A text is cut into pre-tokens by the vocabulary's pattern. Tier one: a
minimal perfect hash over the vocabulary gives each pre-token one slot; if
the slot's entry equals the pre-token, it is one token. Tier two, for the
misses: the bytes form a linked list, adjacent pairs that are in the
vocabulary wait in a heap by rank (then by place), and the lowest is merged
until none is left.

The vocabulary (some 50,000 entries, about 1 MB; its size is fixed by the
rank file) is broadcast. Within a task, results for short pre-tokens are
remembered up to a fixed number and then forgotten, which bounds memory.

Defined cases: a null or empty text has no ids and decodes to the empty
text; texts of any length are encoded whole; of pairs of equal rank the leftmost
merges first; repeated rows and null ids pass through; further columns are left
out, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import plain, read_table, slices, texts_of

MEMO_ENTRIES = 300_000
MEMO_CHARS = 48        # longer pre-tokens are not remembered
KEYS_PER_BUCKET = 4


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@dataclass(frozen=True)
class PerfectHash:
    """Slots 0 to n-1 for n keys: a bucket's displacement moves its keys to
    slots of their own; a bucket with one key names its slot outright."""

    displacement: np.ndarray  # per bucket; -slot-1 for single keys
    size: int

    @staticmethod
    def _mixed(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53) >> np.uint64(16)

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        n = len(keys)
        h = hashes(keys)
        if len(np.unique(h)) < n:
            raise ValueError("two keys share a 64-bit hash")
        n_buckets = max(1, n // KEYS_PER_BUCKET)
        of = (h % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        starts = np.searchsorted(of[order], np.arange(n_buckets + 1))
        displacement = np.zeros(n_buckets, np.int64)
        free = np.ones(n, bool)
        by_size = np.argsort(starts[:-1] - starts[1:], kind="stable")
        for b in by_size:
            own = h[order[starts[b]:starts[b + 1]]]
            if len(own) < 2:
                break
            first, step = 0, 256
            while True:
                d = np.arange(first, first + step, dtype=np.uint64)
                slots = cls._slots(own[:, None], d[None, :], n)
                ok = free[slots].all(axis=0)
                for k in np.flatnonzero(ok):
                    if len(set(slots[:, k].tolist())) == len(own):
                        displacement[b] = first + k
                        free[slots[:, k]] = False
                        break
                else:
                    first += step
                    step = min(step * 2, 65536)
                    continue
                break
        singles = [b for b in by_size if starts[b + 1] - starts[b] == 1]
        displacement[singles] = -np.flatnonzero(free)[:len(singles)] - 1
        return cls(displacement, n)

    @classmethod
    def _slots(cls, h, d, n: int):
        return (cls._mixed(h + d * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)

    def slots(self, keys: list[bytes]) -> np.ndarray:
        h = hashes(keys)
        d = self.displacement[(h % np.uint64(len(self.displacement))).astype(np.int64)]
        return np.where(d < 0, -d - 1, self._slots(h, d.astype(np.uint64), self.size))


def hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token by merging the lowest-ranked adjacent pair, leftmost first."""
    n = len(piece)
    end = list(range(1, n + 1))          # where the part that begins at i ends
    prev = list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []  # rank, start, end of the pair

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (r := ranks.get(piece[i:end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue  # one of its parts has grown meanwhile
        alive[end[i]] = False
        end[i] = stop
        if stop < n:
            prev[stop] = i
        offer(i)
        if prev[i] >= 0:
            offer(prev[i])
    return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]


class Codec:
    """Encoder and decoder over one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, table: PerfectHash | None = None) -> None:
        self.pattern = pattern
        self.ranks = ranks
        keys = list(ranks)
        self.hash = table or PerfectHash.build(keys)
        self.slot_key: list[bytes] = [b""] * len(keys)
        for key, slot in zip(keys, self.hash.slots(keys).tolist()):
            self.slot_key[slot] = key
        self.slot_id = [ranks[k] for k in self.slot_key]
        self.cut = regex.compile(pattern)
        self.bytes_of = {i: k for k, i in ranks.items()}
        self.memo: dict[str, tuple[int, ...]] = {}

    def _learn(self, pieces: list[str], into: dict[str, tuple[int, ...]]) -> None:
        raw = [p.encode("utf-8") for p in pieces]
        for piece, body, slot in zip(pieces, raw, self.hash.slots(raw).tolist()):
            if self.slot_key[slot] == body:
                into[piece] = (self.slot_id[slot],)
            else:
                into[piece] = tuple(merge_bytes(body, self.ranks))

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        cut = [self.cut.findall(t) for t in texts]
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        memo = self.memo
        new = set().union(*cut).difference(memo)
        long = [p for p in new if len(p) > MEMO_CHARS]
        if new:
            self._learn([p for p in new if len(p) <= MEMO_CHARS], memo)
        if long:
            self._learn(long, memo)
        out = [[i for ids in map(memo.__getitem__, pieces) for i in ids] for pieces in cut]
        for p in long:
            del memo[p]
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def load_codec(path: str, pattern: str) -> Codec:
    return Codec(read_ranks(path), pattern)


def _run(df: DataFrame, schema: T.StructType, codec: Codec, rows) -> DataFrame:
    """``rows(codec, ids column, texts)`` gives the arrays after the id."""
    shared = df.sparkSession.sparkContext.broadcast(
        (codec.ranks, codec.pattern, codec.hash.displacement, codec.hash.size))

    def run(batches):
        ranks, pattern, displacement, size = shared.value
        own = Codec(ranks, pattern, PerfectHash(displacement, size))
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), *rows(own, b)], names=names)

    names = schema.fieldNames()
    return df.mapInArrow(run, schema)


def encode(df: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, input_ids`` (array of int) for every row."""
    rows = plain(df, {id_col: id_col, "text": text_col})
    schema = T.StructType([rows.schema[0], T.StructField("input_ids", T.ArrayType(T.IntegerType(), False))])
    return _run(rows, schema, codec, lambda own, b: [
        pa.array(own.encode(texts_of(b)), type=pa.list_(pa.field("element", pa.int32(), nullable=False)))])


def decode(df: DataFrame, codec: Codec, id_col: str = "doc_id", ids_col: str = "input_ids") -> DataFrame:
    """``id, text`` for every row of ids; a null list gives the empty text."""
    rows = plain(df, {id_col: id_col, "input_ids": ids_col})
    schema = T.StructType([rows.schema[0], T.StructField("text", T.StringType())])
    return _run(rows, schema, codec, lambda own, b: [pa.array(
        [own.decode(ids or []).decode("utf-8", "replace") for ids in b.column(1).to_pylist()], type=pa.string())])


def round_trip(df: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text",
               with_ids: bool = False) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` (and ``input_ids``) for every row."""
    rows = plain(df, {id_col: id_col, "text": text_col})
    schema = T.StructType([rows.schema[0], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])
    if with_ids:
        schema = schema.add("input_ids", T.ArrayType(T.IntegerType(), False))

    def digest(own: Codec, b: pa.RecordBatch) -> list[pa.Array]:
        ids = own.encode(texts_of(b))
        out = [pa.array(map(len, ids), type=pa.int64()),
               pa.array([hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in ids], type=pa.string()),
               pa.array([hashlib.sha256(own.decode(x)).hexdigest() for x in ids], type=pa.string())]
        if with_ids:
            out.append(pa.array(ids, type=pa.list_(pa.field("element", pa.int32(), nullable=False))))
        return out

    return _run(rows, schema, codec, digest)


def default_codec() -> Codec:
    import public_tokenizers

    return load_codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "documents"), default_codec())
