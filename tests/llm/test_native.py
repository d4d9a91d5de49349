"""URL filter, sharding, exact dedup, personal data: brute force and awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import pii, sharding
from tessera.llm.common import read_table
from tessera.llm.exact_dedup import exact_dedup, op9_exact_dedup
from tessera.llm.pii import find_pii, op6_pii
from tessera.llm.sharding import op10_sharding, shard_rows
from tessera.llm.url_filter import RULES, Rule, filter_urls, host_and_path, rule_frame
import tessera.llm.exact_dedup as exact_dedup_module
import tessera.llm.url_filter as url_filter

from .helpers import LONG, ROWS, awkward, empty, same_rows

SMALL = "/root/testdata/sf0.001"


# ---- url filter

URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x", "https://www.example.com/en/", "http://example.com/en",
        "http://example.com/en/y?q#f", "http://a.b.example.com/en/z", "http://notexample.com/en/", "http://x.net/es/1",
        "http://x.net/fr", "ftp://net/fr/", "http://com", "http://com/", "http://com?x=/", "http://ex.com#/en/",
        "x://y://com/", "http://" + "a." * 3000 + "com/" + "p/" * 3000, "http://x.com:80/", "http://É.com/a", "http://x.net/es/1"]


def brute_url(url, rules=RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    hits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(hits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else "allow"


@pytest.mark.parametrize("broadcast_rules", [100_000, 0])
def test_urls(spark, monkeypatch, broadcast_rules):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", broadcast_rules)
    rows = [(k // 2, u, "clash", "clash") for k, u in enumerate(URLS)] + [(None, URLS[4], None, None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, id string, host string")
    got = filter_urls(pages, rule_frame(spark, RULES)).collect()
    assert same_rows(got, [(i, u, *brute_url(u)) for i, u, *_ in rows])
    rules = [Rule("com", "/e", "block"), Rule("example.com", "", "allow"), Rule("x.net", "/es/1", "block")]
    got = filter_urls(pages, rule_frame(spark, rules)).collect()
    assert same_rows(got, [(i, u, *brute_url(u, rules)) for i, u, *_ in rows])
    assert filter_urls(pages.limit(0), rule_frame(spark, RULES)).count() == 0


# ---- sharding

def jump(key: int, n: int) -> int:
    key &= 2**64 - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash(spark):
    rng = np.random.default_rng(1)
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *rng.integers(-(2**63), 2**63 - 1, 500).tolist()]
    for n in (1, 2, 16, 100):
        s, g = sharding.jump_shards(F.col("k"), n)
        got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", s.alias("s"), g.alias("g")).collect()
        assert all(r["s"] == jump(r["k"], n) and r["g"] == jump(r["k"], n + 1) for r in got)


def check_shards(spark, rows, got, n=16):
    assert len(got) == len(rows)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots, by_id = defaultdict(list), {}
    for r in got:
        assert r["law"] == "key" and 0 <= r["shard"] < n and r["grown_shard"] in (r["shard"], n)
        assert by_id.setdefault(r["doc_id"], (r["shard"], r["grown_shard"])) == (r["shard"], r["grown_shard"])
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards(spark):
    check_shards(spark, [r[:2] for r in ROWS], shard_rows(awkward(spark)).collect())
    assert shard_rows(empty(spark)).count() == 0
    docs = read_table(spark, SMALL, "documents").select("doc_id", "text").collect()
    got = op10_sharding(spark, SMALL).collect()
    check_shards(spark, [tuple(r) for r in docs], got)
    keys = {r["doc_id"]: r["k"] for r in
            spark.createDataFrame([(r["doc_id"],) for r in docs], "doc_id long").withColumn("k", F.xxhash64("doc_id")).collect()}
    assert all(r["shard"] == jump(keys[r["doc_id"]], 16) and r["grown_shard"] == jump(keys[r["doc_id"]], 17) for r in got)


# ---- exact dedup

def brute_exact(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    ids, size = {}, Counter(norm)
    for (i, _), t in zip(rows, norm):
        if i is not None:
            ids[t] = min(ids.get(t, i), i)
    seen, out = set(), []
    for (i, _), t in zip(rows, norm):
        keep = ids.get(t)
        kept = i == keep and t not in seen
        if kept:
            seen.add(t)
        out.append((i, keep, size[t], kept, hashlib.sha256(t.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("block", [4, 8192])
def test_exact(spark, block):
    more = [(100 + k, t, None, None, None) for k, t in enumerate(
        ["abcdefgh" * 9, "abcdefgh" * 9, "abcdefgh" * 8, "abcd" * 18, "efgh" + "abcd" * 17, "a b", "a  b", "a\tb ", "ab"])]
    rows = [r for r in ROWS if r[1] is not LONG or block > 4]
    df = spark.createDataFrame(rows + more, awkward(spark).schema)
    got = exact_dedup(df, block_chars=block)
    out = got.collect()
    assert same_rows([r[:5] for r in out], brute_exact([r[:2] for r in rows + more]))
    # one identity for each text and one text for each identity
    pairs = {(r["text_sha256"], r["identity"]) for r in out}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_exact_whole_table(spark):
    assert exact_dedup(empty(spark)).count() == 0
    docs = read_table(spark, SMALL, "documents").select("doc_id", "text").collect()
    assert same_rows(op9_exact_dedup(spark, SMALL).collect(), brute_exact([tuple(r) for r in docs]))


def test_exact_groups_follow_the_identity(spark, monkeypatch):
    # names that take all one-block texts for one content must show in the groups
    monkeypatch.setattr(exact_dedup_module, "identities", lambda classes, names: classes.select(
        "cid", F.size("hashes").alias("n"), F.lit(7).cast("long").alias("name")))
    df = spark.createDataFrame([(3, "a"), (1, "b"), (2, "b"), (4, "abcdefgh"), (5, "abcdefgh")], "doc_id long, text string")
    out = exact_dedup(df, block_chars=4).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in out) == [
        (1, 1, 3, True), (2, 1, 3, False), (3, 1, 3, False), (4, 4, 2, True), (5, 4, 2, False)]


# ---- personal data

def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def brute_pii(text):
    pats = {"email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
            "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
            "card": (r"[0-9]([\x20-]?[0-9])+", lambda v: 13 <= len(d := re.sub("[ -]", "", v)) <= 19 and luhn(d)),
            "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(re.sub("[^0-9]", "", v)) <= 15)}
    return [(k, m.start(), m.end()) for k, (p, ok) in pats.items() for m in re.finditer(p, text or "") if ok(m[0])]


PII_TEXTS = [
    "a@b.c_d@e.f x@y.z.@q w@v a@b@c.de \U0001f600 me@x.org", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.0255 1..2.3.4 9.9.9",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 4111  1111 1111 1111", "+1 (743) 555-3824 +33 1 23 45 67 89. +1 2 +123456789012345678",
    "mail me at bob [at] mail [dot] com, call (212) 555-1234 or 415-555-2671, ssn 123-45-6789, iban DE44 5001 0517 5407 3249 31",
    "é" * 50 + "x@y.zz" + "1" * 5000, "@" * 300 + ".", "%" * 20000, "0" * 20000 + " " + "+" * 5000, "1-" * 9000, None, "",
]


def check_pii(rows, got):
    def line(spans):
        return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)

    want = []
    for i, t in rows:
        base = brute_pii(t)
        n = Counter(k for k, _, _ in base)
        want.append((i, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(line(base).encode()).hexdigest(),
                     line(base)))
    assert same_rows([(*r[:6], ",".join(x for x in r["spans"].split(",") if x.split(":")[0] in pii.BASE)) for r in got], want)


def test_pii(spark, monkeypatch):
    rows = list(enumerate(PII_TEXTS)) + [r[:2] for r in ROWS]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, found string, id long")
    monkeypatch.setattr(pii, "read_table", lambda *a: df)
    got = op6_pii(spark, "")
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    out = got.collect()
    check_pii(rows, out)
    added = next(r["spans"] for r in out if r["doc_id"] == 4 and "masked_email" in (r["spans"] or ""))
    assert {x.split(":")[0] for x in added.split(",")} >= {"masked_email", "local_phone", "iban"}
    assert all(r["has_personal_data"] == (r["spans"] != "") for r in out) and {r["has_personal_data"] for r in out} == {True, False}
    assert find_pii(df.limit(0)).count() == 0


def test_pii_whole_table(spark):
    docs = read_table(spark, SMALL, "documents").select("doc_id", "text").collect()
    got = op6_pii(spark, SMALL).collect()
    check_pii([tuple(r) for r in docs], got)


def brute_candidates(text):
    """Spans with votes and features, from the whole text by plain Python."""
    base, found = brute_pii(text), []
    for kind, a, b in base + [(k, m.start(), m.end()) for k, p in pii.SOFT.items() for m in re.finditer(p, text)]:
        if kind in pii.SOFT and any(a < e and s < b for _, s, e in base):
            continue
        v, before, after = text[a:b], text[max(a - 40, 0):a], text[b:b + 20]
        digits = sum(c in "0123456789" for c in v)
        cue = next((n for n, w in pii._CUES.items() if re.search(rf"\b({w})\b", before, re.I | re.A)), "none")
        both = re.search(pii._CUE, before, re.A) or re.search(pii._CUE, after, re.A)
        glued = re.search("[0-9A-Za-z]$", before) or re.search("^[0-9A-Za-z]", after)
        votes = [-1 if p is None else int(bool(re.search(p, v))) for p in (pii._STRICT[kind], pii._GAZETTEER[kind])]
        beside = ["word" if re.fullmatch("[0-9A-Za-z]", c) else "mark" if re.fullmatch(r"\S", c, re.A) else "blank"
                  for c in (before[-1:], after[:1])]
        found.append((kind, a, b, v, *votes, 1 if both else 0 if glued else -1, min(len(v) // 8, 3),
                      2 * digits // len(v), *beside, cue))
    return found


def test_candidates_of_many_spans_a_text(spark):
    """More spans than a block holds, contexts across blocks, base and soft spans that overlap."""
    rng = random.Random(11)
    bits = ["a@b.com ", "x.y@z.org, ", "1.2.3.4 ", "4111 1111 1111 1111 ", "+1 (743) 555-3824 ", "call (212) 555-1234 ",
            "ssn 123-45-6789", "=123-45-6789;", " bob [at] mail [dot] com ", "DE44 5001 0517 5407 3249 31 ", "word ", "17 ",
            "\n", "q" * 70 + " ", "card ", "12" * 40 + " ", "7", "\U0001f600"]
    texts = ["".join(rng.choices(bits, k=n)) for n in (1, 5, 40, 100, 400, 1000) * 4]
    got = pii.candidates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["id"]: [tuple(x) for x in r["found"]] for r in got} == dict(enumerate(map(brute_candidates, texts)))
    assert max(len(r["found"]) for r in got) > 5 * pii.BLOCK


def test_a_text_of_very_many_numbers(spark):
    df = spark.createDataFrame([(1, "17 205 " * 100_000)], "doc_id long, text string")
    assert pii.candidates(df).collect() == [(1, [])]


def test_span_classifier_on_held_out_spans(spark):
    """Spans with equal votes are told apart by what stands beside them."""
    rng = random.Random(2)

    def row(k):
        number = f"{rng.randrange(2, 10)}{rng.randrange(0, 9)}{rng.randrange(10)}-{rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
        wrong = f"{rng.choice('01')}{rng.randrange(10, 99)}-{rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
        if k % 2:
            return f"{rng.choice(('call', 'phone', 'mobile', 'so'))} {number} today", True
        return f"part#{rng.choice((wrong, wrong, number))};" + " box", False

    rows = [(k, *row(k)) for k in range(2000)]
    found = pii.candidates(spark.createDataFrame(rows, "doc_id long, text string, truth boolean")).cache()
    model = pii.fit_spans(found.where("id < 1000"))
    judged = found.where("id >= 1000").select("id", F.exists("found", model.accepts).alias("is")).collect()
    assert len(judged) == 1000
    assert sum(r["is"] == rows[r["id"]][2] for r in judged) >= 950
    # the labelers alone take the numbers of the right form after a mark for true, too
    votes = sum(F.element_at("found", 1)[v] for v in pii.VOTES)
    alone = found.where("id >= 1000").select("id", (votes > 0).alias("is")).collect()
    assert sum(r["is"] == rows[r["id"]][2] for r in alone) < 900


def test_reliabilities_find_the_better_labeler():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.4
    right = [0.95, 0.9, 0.6]
    votes = np.stack([np.where(rng.random(len(truth)) < p, truth, ~truth).astype(int) for p in right], 1)
    patterns, inverse, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, table = pii.reliabilities(n.astype(float), patterns, np.zeros(len(n), int))
    assert ((posterior[inverse.ravel()] > 0.5) == truth).mean() > 0.94
    assert abs(table[0, 1, 1] - 0.95) < 0.03 and abs(table[2, 1, 1] - 0.6) < 0.03
