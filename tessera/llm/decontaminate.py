"""Benchmark decontamination by pigeonhole edit matching.

A test item of n characters may appear in a document with up to k errors
(k = ``ERROR_RATE`` of n). Cut into k + 1 pieces, at least one piece must
then appear unchanged. All pieces go into one automaton that finds exact
hits in a single pass over each text; the text around a hit is verified with
Myers' bit-parallel edit distance against the whole item.

A piece that many items share, as in a benchmark whose items have a common
stem, is verified for all of them at once.

Texts and items are compared in lower case with white-space runs made one
space. Items are taken in blocks of at most ``BLOCK_ITEMS`` items and
``BLOCK_CHARS`` characters of pieces, one block is broadcast at a time, and
every document is read against every block. The distance reported is the
least of the item to any part of the text, whatever the blocks.

Defined cases: null and empty texts are clean; a text of any length is read
whole; empty items match nothing; items so short that k is 0 must appear
whole and between word boundaries; repeated items count once by id and text;
items of equal distance are listed by id; repeated rows and null ids pass
through; an empty table gives an empty result; further columns, whatever
their names, are not read (or, where rows are kept, pass through).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.common import keep_rows, materialize, plain, read_table, slices, text_or_empty, texts_of

ERROR_RATE = 0.05
BLOCK_ITEMS = 50_000
BLOCK_CHARS = 4_000_000   # of pieces in one automaton
# items that share a piece and are verified together, from so many on, and at most at a time
MANY, TOGETHER = 24, 4096
# fills up shorter patterns: no code point
NO_CODE = 0xFFFFFFFF

# id, normalised text, number, first and last (exclusive) of the pieces to look for
Item = tuple[object, str, int, int, int]


def normalize(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of nearly equal length with their offsets."""
    n, parts = len(item), errors + 1
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers_distance(pattern: str, text: str) -> int:
    """Least edit distance of ``pattern`` to any part of ``text``."""
    m = len(pattern)
    if not m:
        return 0
    masks: dict[str, int] = defaultdict(int)
    for i, ch in enumerate(pattern):
        masks[ch] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    vp, vn, score = full, 0, m
    best = m
    for ch in text:
        x = masks.get(ch, 0)
        d0 = (((x & vp) + vp) ^ vp) | x | vn
        hp = vn | ~(d0 | vp) & full
        hn = d0 & vp
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp = hp << 1 & full
        hn = hn << 1 & full
        vp = (hn | ~(d0 | hp)) & full
        vn = hp & d0
        if score < best:
            best = score
    return best


def myers_distances(patterns: np.ndarray, lengths: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Least edit distance of each pattern to any part of ``text``: Myers' recurrence for all patterns at once.

    ``patterns`` holds code points, a row each, filled up with a number that
    no text holds; a pattern has a bit each in one or more 64-bit words.
    """
    n, words = len(patterns), max(1, -(-patterns.shape[1] // 64))
    one, high = np.uint64(1), np.uint64(63)
    masks: dict[int, np.ndarray] = {}
    for code in np.unique(text).tolist():
        bits = np.zeros((n, words * 64), bool)
        bits[:, :patterns.shape[1]] = patterns == code
        masks[code] = np.ascontiguousarray(np.packbits(bits, axis=1, bitorder="little").view("<u8").T)
    ends = [np.where((lengths - 1) // 64 == w, one << ((lengths - 1) % 64).astype(np.uint64), np.uint64(0))
            for w in range(words)]
    vp, vn = np.full((words, n), ~np.uint64(0)), np.zeros((words, n), np.uint64)
    score = lengths.astype(np.int64)
    best = score.copy()
    for code in text.tolist():
        mask = masks[code]
        carry = hp_in = hn_in = np.uint64(0)
        for w in range(words):
            x, pos, neg = mask[w], vp[w], vn[w]
            both = x & pos
            half = both + pos
            total = half + carry
            d0 = (total ^ pos) | x | neg
            hp, hn = neg | ~(d0 | pos), d0 & pos
            carry = ((half < both) | (total < half)).astype(np.uint64)
            score += (hp & ends[w]) != 0
            score -= (hn & ends[w]) != 0
            hp_next, hn_next = hp >> high, hn >> high
            hp, hn = hp << one | hp_in, hn << one | hn_in
            hp_in, hn_in = hp_next, hn_next
            vp[w], vn[w] = hn | ~(d0 | hp), hp & d0
        np.minimum(best, score, out=best)
    return best


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class Group:
    """Items with the same piece at the same place and the same error budget: a hit fits all or none of them."""

    def __init__(self, members: list[int], offset: int, errors: int) -> None:
        self.members, self.offset, self.errors = np.array(members), offset, errors


class Matcher:
    """Finds the items of one block in a normalised text.

    A hit of a piece is verified for every item that has the piece there:
    one by one where they are few, all at once (``myers_distances``) where a
    stem is shared by many. The distance is the least over all hits, so it
    does not depend on which pieces stand in the same block.
    """

    def __init__(self, items: list[Item], error_rate: float) -> None:
        self.items = items
        self.errors = [int(len(item[1]) * error_rate) for item in items]
        self.automaton = ahocorasick.Automaton()
        places: dict[str, dict[tuple[int, int], list[int]]] = defaultdict(lambda: defaultdict(list))
        for k, (_, text, _, first, last) in enumerate(items):
            for offset, piece in pieces(text, self.errors[k])[first:last]:
                places[piece][offset, self.errors[k]].append(k)
        for piece, groups in places.items():
            self.automaton.add_word(piece, (len(piece), [Group(m, o, e) for (o, e), m in groups.items()]))
        if places:
            self.automaton.make_automaton()

    def _windows(self, text: str) -> Iterator[tuple[int, int, np.ndarray]]:
        """``(error budget, place, items)``: windows to verify, each once per item."""
        tried: dict[tuple[int, int], set[int]] = defaultdict(set)
        for end, (size, groups) in self.automaton.iter(text):
            for group in groups:
                # hits that one window covers are tried once; without errors the place is exact
                place = (end + 1 - size - group.offset) // (group.errors + 1)
                seen = tried[group.errors, place]
                if seen:
                    new = np.array([k for k in group.members.tolist() if k not in seen], int)
                else:
                    new = group.members
                if len(new):
                    seen.update(new.tolist())
                    yield group.errors, place, new

    def _whole(self, text: str, start: int, k: int) -> bool:
        """Does an item without error budget, found at ``start``, stand between word boundaries?"""
        item, end = self.items[k][1], start + len(self.items[k][1])
        return not (start > 0 and text[start - 1].isalnum() and item[0].isalnum()
                    or end < len(text) and text[end].isalnum() and item[-1].isalnum())

    def _distances(self, text: str, errors: int, place: int, members: np.ndarray) -> Iterator[tuple[int, int]]:
        """Items of one window and their distances."""
        if not errors:
            yield from ((k, 0) for k in members.tolist() if self._whole(text, place, k))
            return
        low = place * (errors + 1) - errors
        reach = 3 * errors + 1  # errors before, and the place's own uncertainty behind
        if len(members) < MANY:
            for k in members.tolist():
                item = self.items[k][1]
                yield k, myers_distance(item, text[max(0, low):max(0, low + len(item) + reach)])
            return
        lengths = np.array([len(self.items[k][1]) for k in members])
        # items of one budget differ by less than a word; a window of the longest holds every other
        window = code_points(text[max(0, low):max(0, low + int(lengths.max()) + reach)])
        for at in range(0, len(members), TOGETHER):
            part = members[at:at + TOGETHER]
            rows = np.full((len(part), int(lengths.max())), NO_CODE, np.uint32)
            for row, k in enumerate(part.tolist()):
                rows[row, :len(self.items[k][1])] = code_points(self.items[k][1])
            yield from zip(part.tolist(), myers_distances(rows, lengths[at:at + TOGETHER], window).tolist())

    def found(self, text: str) -> list[tuple[Item, int]]:
        """``(item, distance)`` of every item that is in ``text``, with its least distance to a part of it."""
        if not text or not len(self.automaton):
            return []
        best: dict[int, int] = {}
        for errors, place, members in self._windows(text):
            for k, distance in self._distances(text, errors, place, members):
                if distance <= errors and distance < best.get(k, errors + 1):
                    best[k] = distance
        return [(self.items[k], distance) for k, distance in best.items()]

    def any_in(self, text: str) -> bool:
        """Is any item in ``text``? Stops at the first."""
        return bool(text and len(self.automaton)) and any(
            distance <= errors for errors, place, members in self._windows(text)
            for _, distance in self._distances(text, errors, place, members))


def _dealt(benchmark: DataFrame, id_col: str, text_col: str, block_items: int, block_chars: int) -> DataFrame:
    """``id, text, block``: normalised, distinct items; one that is too long for a block is alone in its own."""
    rows = plain(benchmark, {"id": id_col, "text": text_col})
    schema = T.StructType([rows.schema["id"], T.StructField("text", T.StringType())])

    def normalized(batches):
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([normalize(t) for t in texts_of(b)], pa.string())], names=["id", "text"])

    def numbered(batches):
        block, n, chars = TaskContext.get().partitionId() << 32, 0, 0
        for b in slices(batches):
            blocks = []
            for text in texts_of(b):
                if n and (n == block_items or chars + len(text) > block_chars):
                    block, n, chars = block + 1, 0, 0
                n, chars = n + 1, chars + len(text)
                blocks.append(block)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(blocks, pa.int64())], names=["id", "text", "block"])

    items = materialize(rows.mapInArrow(normalized, schema).where("text != ''").distinct(), "items")
    total = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    least = max(1, -(-total["n"] // block_items), -(-total["chars"] // block_chars))
    schema = T.StructType([*schema, T.StructField("block", T.LongType())])
    return materialize(items.coalesce(least).mapInArrow(numbered, schema), "benchmark-blocks")


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, error_rate: float, block_items: int,
            block_chars: int) -> Iterator[list[Item]]:
    """The pieces of all items, a bounded block at a time."""
    items, number = _dealt(benchmark, id_col, text_col, block_items, block_chars), 0
    for (block,) in items.select("block").distinct().orderBy("block").collect():
        rows = [(r["id"], r["text"]) for r in items.where(F.col("block") == block).collect()]
        counts = [int(len(t) * error_rate) + 1 for _, t in rows]
        # only an item that is alone can be too long
        step = max(1, block_chars * counts[0] // len(rows[0][1])) if len(rows) == 1 else max(counts)
        for first in range(0, max(counts), step):
            yield [(i, t, number + k, first, first + step) for k, (i, t) in enumerate(rows)]
        number += len(rows)


def _found(docs: DataFrame, blocks: Iterator[list[Item]], text_col: str, item_type: T.DataType,
           error_rate: float) -> DataFrame:
    """``key, hits`` of every text that holds an item, by the text's digest; a block's broadcast ends before the next."""
    rows = docs.select(_key(text_col).alias("key"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("number", T.LongType()),
                           T.StructField("item", item_type), T.StructField("distance", T.IntegerType())])
    item_arrow = to_arrow_type(item_type)
    written = []
    for block in blocks:
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            matcher = Matcher(shared.value, error_rate)
            for b in slices(batches):
                new = [(key, item[2], item[0], distance) for key, t in zip(b.column(0).to_pylist(), texts_of(b))
                       for item, distance in matcher.found(normalize(t))]
                kinds = (pa.string(), pa.int64(), item_arrow, pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in new], kind) for c, kind in enumerate(kinds)],
                                                 names=schema.fieldNames())

        written.append(materialize(rows.mapInArrow(run, schema), "hits"))
        shared.destroy()
    # a repeated text, or an item whose pieces lie in several blocks, is found more than once
    return (reduce(DataFrame.unionByName, written).groupBy("key", "number", "item").agg(F.min("distance").alias("distance"))
            .groupBy("key").agg(F.collect_list(F.struct("item", "distance")).alias("hits")))


def _key(text_col: str):
    return F.sha2(text_or_empty(f"`{text_col}`").cast("binary"), 256)


def _matcher_of(spark, block: list[Item], error_rate: float):
    shared = spark.sparkContext.broadcast(block)
    return lambda: Matcher(shared.value, error_rate)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", error_rate: float = ERROR_RATE,
                  block_items: int = BLOCK_ITEMS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``id, contaminated, n_items, item_ids, distances`` for every row of ``docs``."""
    item_type = benchmark.schema[item_id].dataType
    hits = T.ArrayType(T.StructType([T.StructField("item", item_type), T.StructField("distance", T.IntegerType())]))
    blocks = _blocks(benchmark, item_id, item_text, error_rate, block_items, block_chars)
    block, more = next(blocks, []), next(blocks, None)
    if more is None:
        rows = plain(docs, {"id": id_col, "text": text_col}).withColumn("hits", F.lit(None).cast(hits))
        rows = _add_hits(rows, _matcher_of(docs.sparkSession, block, error_rate))
    else:
        found = _found(docs, chain((block, more), blocks), text_col, item_type, error_rate)
        rows = docs.select(F.col(f"`{id_col}`").alias("id"), _key(text_col).alias("key")).join(found, "key", "left")
    found = F.array_sort(F.coalesce(F.col("hits").cast(hits), F.array().cast(hits)))
    return (rows.withColumn("hits", found)
            .select(F.col("id").alias(id_col), (F.size("hits") > 0).alias("contaminated"),
                    F.size("hits").cast("long").alias("n_items"),
                    F.col("hits.item").alias("item_ids"), F.col("hits.distance").alias("distances")))


def _add_hits(rows: DataFrame, matcher_of) -> DataFrame:
    def run(batches):
        matcher = matcher_of()
        for b in slices(batches):
            new = [[{"item": item[0], "distance": d} for item, d in matcher.found(normalize(t))] for t in texts_of(b)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(new, type=b.column(2).type)],
                                             names=["id", "text", "hits"])

    return rows.mapInArrow(run, rows.schema)


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text", error_rate: float = ERROR_RATE, block_items: int = BLOCK_ITEMS,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item; columns stay."""
    blocks = _blocks(benchmark, item_id, item_text, error_rate, block_items, block_chars)
    block, more = next(blocks, []), next(blocks, None)
    if more is None:
        matcher_of = _matcher_of(docs.sparkSession, block, error_rate)

        def decide():
            matcher = matcher_of()
            return lambda texts: [not matcher.any_in(normalize(t)) for t in texts]

        return keep_rows(docs, text_col, decide)
    found = _found(docs, chain((block, more), blocks), text_col, benchmark.schema[item_id].dataType, error_rate)
    # the texts are shuffled once, the digests are the build side
    dirty = found.select(F.col("key").alias("__dirty")).hint("shuffle_hash")
    return docs.join(dirty, _key(text_col) == F.col("__dirty"), "left_anti")


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    return decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
