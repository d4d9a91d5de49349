"""Packing: every token in one piece, window law, awkward rows, merge rounds, the library's ids."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from tessera.llm import packing
from tessera.llm.common import read_table
from tessera.llm.packing import (
    Piece, Windows, closing_sizes, cut_to, default_encoder, load_encoder, op11_packing, pack_documents, sequences,
)

from .helpers import ROWS, awkward, empty

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def tokens(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def padding(rows):
    fill = {}
    for r in rows:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 1024
    return sum(1024 - n for n in fill.values() if n & (n - 1)), sum(fill.values())


def assert_gapless(rows):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length


def rebuilt(rows, bodies):
    """Checks each piece against one of its id's documents; returns the tokens found, by id."""
    found = {}
    for r in rows:
        at, to = r["start"], r["start"] + r["length"]
        fits = [b for b in bodies[r["doc_id"]] if len(b) == r["doc_tokens"]
                and zlib.crc32(np.array(b[at:to], "<u4").tobytes()) == r["ids_crc32"]]
        assert fits, r
        found.setdefault((r["doc_id"], r["doc_tokens"]), []).append((at, to))
    return found


def assert_whole(rows, bodies):
    found = rebuilt(rows, bodies)
    for id, texts in bodies.items():
        for size in {len(b) for b in texts}:
            copies = sum(len(b) == size for b in texts)
            places = np.zeros(size, int)
            for at, to in found[(id, size)]:
                places[at:to] += 1
            assert (places == copies).all()


def test_every_token_of_a_table_once(spark, tokenizer):
    docs = read_table(spark, SMALL, "documents")
    bodies = {}
    for r in docs.collect():
        bodies.setdefault(r["doc_id"], []).append(tokens(tokenizer, r["text"]))
    rows = op11_packing(spark, SMALL).collect()
    assert_whole(rows, bodies)
    assert_gapless(rows)
    padded, total = padding(rows)
    assert padded < 0.01 * total


@pytest.mark.parametrize("fan", [2, 64])
def test_awkward_rows(spark, tokenizer, monkeypatch, fan):
    monkeypatch.setattr(packing, "FAN", fan)
    bodies = {}
    for row in ROWS:
        bodies.setdefault(row[0], []).append(tokens(tokenizer, row[1]))
    for docs in (awkward(spark).coalesce(1), awkward(spark).repartition(7)):
        rows = pack_documents(docs, default_encoder()).collect()
        assert_whole(rows, bodies)
        assert_gapless(rows)
        # all that is left is cut to powers of two
        assert padding(rows)[0] == 0
    done = pack_documents(empty(spark), default_encoder())
    assert done.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert done.count() == 0


def test_text_ids(spark):
    docs = spark.createDataFrame([("a", "one"), (None, "two"), ("a", "three")], "doc_id string, text string")
    rows = pack_documents(docs, default_encoder()).collect()
    assert sorted(str(r["doc_id"]) for r in rows if r["start"] == 0) == ["None", "a", "a"]


def test_sequences_hold_the_tokens(spark, tokenizer):
    docs = read_table(spark, SMALL, "documents")
    pieces = pack_documents(docs, default_encoder(), with_ids=True)
    whole = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in sequences(pieces).collect()}
    bodies = {r["doc_id"]: tokens(tokenizer, r["text"]) for r in docs.collect()}
    for r in pieces.collect():
        own = whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]]
        assert own.tolist() == bodies[r["doc_id"]][r["start"]:r["start"] + r["length"]]


def test_encoder_equals_the_library(tokenizer):
    encode = default_encoder().load()
    texts = ["", " ", "a", "naïve café 中文 \U0001f600", "<|endoftext|> x", "it's  we'll\n\n 12 345", "\x1c\x85 ſK",
             "x" * 5000, " " * 5000 + "a", "中" * 3000, "ab " * 3000, "\t \n" * 2000]
    texts += [f"a{chr(c)}1{chr(c)} {chr(c)}!{chr(c)}{chr(c)}" for c in range(1, 0x3000, 7)]
    for text in texts:
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:20]


def test_paths_are_parameters(tmp_path):
    (tmp_path / "t.json").write_text("{}")
    (tmp_path / "r").write_bytes(b"YQ== 0")
    own = load_encoder(str(tmp_path / "t.json"), str(tmp_path / "r"), "a")
    assert (own.tokenizer, own.ranks, own.pattern) == ("{}", b"YQ== 0", "a")


def naive(sizes, width, keep, least):
    """Best fit over a plain list of windows, as its definition says."""
    windows, closed = [], []
    for size in sizes:
        while size >= width:
            closed.append([width])
            size -= width
        while size:
            fits = [w for w in windows if width - sum(w) >= size]
            if fits:
                best = min(fits, key=lambda w: (width - sum(w), windows.index(w)))
                best.append(size)
                if sum(best) == width:
                    windows.remove(best)
                    closed.append(best)
                size = 0
            elif len(windows) < keep:
                windows.append([size])
                size = 0
            else:
                full = max(windows, key=sum)
                windows.remove(full)
                gap = width - sum(full)
                if gap >= least:
                    full.append(gap)
                    size -= gap
                closed.append(full)
    return closed, windows


@pytest.mark.parametrize("keep, least", [(1, 1), (3, 4), (8, 16), (4, 1000)])
def test_windows_against_a_plain_list(keep, least):
    rng = np.random.default_rng(keep)
    sizes = rng.integers(1, 150, 400).tolist()
    windows, closed = Windows(100, keep, least), []
    for size in sizes:
        closed += list(windows.add(Piece(0, 0, np.zeros(size, np.uint32), size)))
        assert len(windows.open) == len(windows.gaps) <= keep
    want, left = naive(sizes, 100, keep, least)
    assert [[len(p.ids) for p in w] for w in closed] == want
    assert sorted(sum(len(p.ids) for p in w) for w in windows.rest()) == sorted(map(sum, left))


def test_closing_windows():
    for n in (1, 2, 3, 1023, 1024, 1025, 5000):
        sizes = closing_sizes(n, 1024)
        assert sum(sizes) == n and all(s == 1024 or not s & (s - 1) for s in sizes)
        pieces = [Piece(0, 0, np.arange(n // 2, dtype=np.uint32), n), Piece(0, n // 2, np.arange(n // 2, n, dtype=np.uint32), n)]
        cut = list(cut_to(pieces, sizes))
        assert [sum(len(p.ids) for p in w) for w in cut] == sizes
        assert np.concatenate([p.ids for w in cut for p in w]).tolist() == list(range(n))
