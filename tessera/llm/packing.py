"""Packing of tokenized documents into fixed windows, bounded-space best fit.

A document's tokens are followed by an end token. Each task keeps a fixed
number of open windows. A document fills whole windows of its own first; what
is left of it goes, uncut, into the open window that it fits best (the
smallest gap that holds it), or opens a new one. Where none fits and all are
open, the fullest is emitted: a gap of ``LEAST`` tokens or more is filled with
the head of the document at hand, a smaller one is padded. So a task holds
``OPEN`` windows and one batch of texts, whatever it reads.

Windows that are still open at the end of a task are merged: the leftovers of
``FAN`` tasks are dealt to one, which packs their pieces again, largest first,
and leaves at most ``OPEN`` windows to the next round, until one task is left.
The last tokens are cut to windows of a power of two, which need no padding.
Each round's groups hold at most ``FAN * OPEN`` windows, and each round has
``FAN`` times fewer of them.

The texts are read once. The pieces of closed windows and the leftovers (with
their tokens) are written to the shared folder, from which the rounds go on.

Tokens are those of the byte-level tokenizer of the ``tokenizers`` library
whose file is given. Its vocabulary as ranks lets tiktoken find the same ids
several times faster; texts with a run of ``LONG_RUN`` characters without a
blank, or of blanks, on which tiktoken's time is quadratic, go through
``tokenizers`` itself.

Defined cases: a null text is the empty text, whose one piece is the end
token; a text of any length is cut into as many windows as it needs; repeated
rows and rows that share an id, or have none, are documents each; of equal
gaps the window that was opened first is taken; an empty table gives an empty
result. Special tokens' names in a text are ordinary text. Further columns,
whatever their names, are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize, plain, read_table, slices, texts_of

WIDTH = 1024
# open windows of a task; tokens that a piece cut to fill a gap has at least
OPEN, LEAST = 64, 16
# tasks whose leftovers one task merges
FAN = 64
LONG_RUN = 2000
# pieces that a task holds back before it hands them on
FLUSH = 8192
# a sequence id: round, task and window number
_ROUND_BITS, _PART_BITS = 58, 30


@dataclass(frozen=True)
class Encoder:
    """Contents of a tokenizer's JSON file, of the same vocabulary as ranks, and the pattern of the ranks."""

    tokenizer: str
    ranks: bytes
    pattern: str

    def load(self) -> Callable[[str], np.ndarray]:
        import tiktoken
        from tokenizers import Tokenizer

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.ranks.splitlines())}
        fast = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        slow: list[Tokenizer] = []
        run = re.compile(r"\s{%d}" % LONG_RUN)

        def encode(text: str) -> np.ndarray:
            if len(text) >= LONG_RUN and (max(map(len, text.split()), default=0) >= LONG_RUN or run.search(text)):
                if not slow:
                    slow.append(Tokenizer.from_str(self.tokenizer))
                    slow[0].encode_special_tokens = True
                return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)
            return fast.encode_to_numpy(text, disallowed_special=())

        return encode


def load_encoder(tokenizer_path: str, ranks_path: str, pattern: str) -> Encoder:
    with open(tokenizer_path, encoding="utf-8") as t, open(ranks_path, "rb") as r:
        return Encoder(t.read(), r.read(), pattern)


@dataclass(slots=True)
class Piece:
    """Tokens ``ids`` of document ``id``, which follow its first ``start`` tokens of ``total``."""

    id: object
    start: int
    ids: np.ndarray
    total: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (Piece(self.id, self.start, self.ids[:at], self.total),
                Piece(self.id, self.start + at, self.ids[at:], self.total))


class Windows:
    """At most ``keep`` open windows of ``width`` tokens; ``add`` yields those that it closes."""

    def __init__(self, width: int, keep: int, least: int) -> None:
        self.width, self.keep, self.least = width, keep, least
        self.gaps: list[tuple[int, int]] = []
        self.open: dict[int, list[Piece]] = {}
        self.opened = 0

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece.ids) >= self.width:
            whole, piece = piece.cut(self.width)
            yield [whole]
        while len(piece.ids):
            size = len(piece.ids)
            at = bisect_left(self.gaps, (size, 0))
            if at < len(self.gaps):
                gap, window = self.gaps.pop(at)
                self.open[window].append(piece)
                if gap > size:
                    insort(self.gaps, (gap - size, window))
                else:
                    yield self.open.pop(window)
                return
            if len(self.gaps) < self.keep:
                self.opened += 1
                self.open[self.opened] = [piece]
                insort(self.gaps, (self.width - size, self.opened))
                return
            gap, window = self.gaps.pop(0)
            if gap >= self.least:
                head, piece = piece.cut(gap)
                self.open[window].append(head)
            yield self.open.pop(window)

    def rest(self) -> list[list[Piece]]:
        """The windows still open, fullest first."""
        return [self.open[window] for _, window in self.gaps]


def cut_to(pieces: list[Piece], sizes: list[int]) -> Iterator[list[Piece]]:
    """The pieces one after the other, cut into windows of the given sizes (their sum)."""
    pieces = pieces[::-1]
    for size in sizes:
        window = []
        while size:
            piece = pieces.pop()
            if len(piece.ids) > size:
                piece, rest = piece.cut(size)
                pieces.append(rest)
            window.append(piece)
            size -= len(piece.ids)
        yield window


def closing_sizes(tokens: int, width: int) -> list[int]:
    """Sizes of the last windows: whole ones, then powers of two."""
    rest = tokens % width
    return [width] * (tokens // width) + [1 << k for k in range(width.bit_length(), -1, -1) if rest >> k & 1]


class _Out:
    """Piece rows of one task, as Arrow batches."""

    def __init__(self, part: int, id_type: pa.DataType, with_ids: bool) -> None:
        self.part, self.id_type, self.with_ids, self.rows, self.window = part, id_type, with_ids, [], 0

    def add(self, pieces: list[Piece], closed: bool) -> None:
        offset = 0
        for p in pieces:
            data = p.ids.astype("<u4").tobytes()
            self.rows.append((p.id, p.start, len(p.ids), zlib.crc32(data), p.total, self.window, offset, closed,
                              data if self.with_ids or not closed else None))
            offset += len(p.ids)
        self.window += 1

    def table(self) -> pa.Table:
        columns = list(zip(*self.rows)) or [()] * 9
        self.rows = []
        kinds = [self.id_type, *[pa.int64()] * 6, pa.bool_(), pa.binary()]
        out = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
        out.insert(5, pa.array([self.part] * len(out[0]), pa.int64()))
        return pa.Table.from_arrays(out, names=_NAMES)


_NAMES = ["id", "start", "length", "ids_crc32", "doc_tokens", "part", "window", "offset", "closed", "ids"]


def _schema(id_type: T.DataType) -> T.StructType:
    schema = T.StructType().add("id", id_type)
    for name in _NAMES[1:8]:
        schema.add(name, T.LongType())
    return schema.add("closed", T.BooleanType()).add("ids", T.BinaryType())


def _pack(docs: DataFrame, encoder, end: int, width: int, keep: int, least: int, with_ids: bool) -> DataFrame:
    """Pieces of every document: those of closed windows, and those of the windows a task leaves open."""

    def run(batches):
        encode, windows, out = encoder.value.load(), Windows(width, keep, least), None
        for b in slices(batches):
            out = out or _Out(TaskContext.get().partitionId(), b.schema.field(0).type, with_ids)
            for id, text in zip(b.column(0).to_pylist(), texts_of(b)):
                ids = np.append(encode(text), np.uint32(end))
                for closed in windows.add(Piece(id, 0, ids, len(ids))):
                    # a window's pieces are parts of whole documents' arrays
                    out.add(closed, True)
                if len(out.rows) >= FLUSH:
                    yield from out.table().to_batches()
        if out:
            for window in windows.rest():
                out.add(window, False)
            yield from out.table().to_batches()

    return docs.mapInArrow(run, _schema(docs.schema["id"].dataType))


def _merge(rest: DataFrame, groups: int, width: int, keep: int, least: int, with_ids: bool) -> DataFrame:
    """One round: the leftovers of ``FAN`` tasks are packed together; with one group left, all are closed."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["id", "start", "ids", "doc_tokens"]).to_pylist()
        pieces = [Piece(r["id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"]) for r in rows]
        pieces.sort(key=lambda p: (-len(p.ids), p.id is None, p.id if p.id is not None else 0, p.start))
        windows = Windows(width, keep, least)
        out = _Out(table.column("part")[0].as_py(), table.schema.field("id").type, with_ids)
        for piece in pieces:
            for closed in windows.add(piece):
                out.add(closed, True)
        if groups > 1:
            for window in windows.rest():
                out.add(window, False)
        else:
            left = [p for window in windows.rest() for p in window]
            for window in cut_to(left, closing_sizes(sum(len(p.ids) for p in left), width)):
                out.add(window, True)
        return out.table()

    dealt = rest.withColumn("part", F.floor(F.col("part") / FAN))
    return dealt.groupBy("part").applyInArrow(run, rest.schema)


def pack_documents(docs: DataFrame, encoder: Encoder, end: int = 0, width: int = WIDTH, open_windows: int = OPEN,
                   least: int = LEAST, id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``with_ids`` adds ``ids``, the piece's tokens as little-endian 32-bit
    numbers (:func:`sequences` puts them together).
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(encoder)
    own = plain(docs, {"id": id_col, "text": text_col})
    state = materialize(_pack(own, shared, end, width, open_windows, least, with_ids), "packing")
    rounds, rest = [state.where("closed")], state.where("NOT closed")
    tasks = (rest.agg(F.max("part")).first()[0] or 0) + 1 if not rest.isEmpty() else 0
    while tasks:
        groups = -(-tasks // FAN)
        state = materialize(_merge(rest, groups, width, open_windows, least, with_ids), "packing-merge")
        rounds.append(state.where("closed"))
        rest, tasks = state.where("NOT closed"), groups if groups > 1 else 0
    numbered = [r.withColumn("sequence_id", F.lit(k << _ROUND_BITS) + F.shiftleft("part", _PART_BITS) + F.col("window"))
                for k, r in enumerate(rounds)]
    columns = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]
    return reduce(DataFrame.unionAll, numbered).select(F.col("id").alias(id_col), *columns)


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, ids, n_tokens``: whole sequences, from pieces with their ids; a group is one window."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda all_, part: F.concat(all_, part["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("n_tokens"))


def default_encoder() -> Encoder:
    import public_tokenizers

    return load_encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                        public_tokenizers.PATTERN)


def op11_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), default_encoder())
