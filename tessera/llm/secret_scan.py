"""Secret scan with multipart credential linking.

Strong findings come from three patterns (assignments, access identifiers,
long hex strings). A credential often has several parts, of which some look
harmless alone: the scan also takes weak candidates, namely short or bare
key-like strings (``key``), user names (``user``) and service endpoints
(``endpoint``). Parts are linked by an interval join: the candidate's
interval, widened by the scope, is joined with the intervals of the parts
that complement it. A weak candidate is reported only if the join finds one
within the same scope (``SCOPE_CHARS`` characters, and no blank line between).

Complements: ``key`` needs an access identifier, a user name or an endpoint;
``user`` and ``endpoint`` need an assignment, an access identifier, a long hex
string or a key. Of two weak parts that overlap (a key in its own endpoint's
path) neither confirms the other.

A key is a whole run of at least 32 characters of the base64 or the URL-safe
base64 alphabet, however long, with a digit, a capital and a small letter.
Where a run of one alphabet lies inside a run of the other, the longer counts.
A run that reads as a path or a slug (two or more parts between ``/ - _``, each
a number of up to eight digits or words, maybe capitalized, with a number of up
to four digits) is no key.

Scopes lie inside one document, so each task scans whole texts and joins
their parts in place; nothing is shuffled and rows need no unique id.

Defined cases: a null text counts as empty and has no finding; texts of any
length are scanned whole; findings that begin together are ordered by kind;
repeated rows and null ids pass through; further columns are left out, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import plain, read_table, slices, texts_of

SCOPE_CHARS = 400

# kinds in the order of the report
KINDS = ("assign", "access", "hex", "key", "user", "endpoint")
BASE = ("assign", "access", "hex")

_ASSIGN = re.compile(
    r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
# a text without one of these has no assignment: all keywords hold one of them
_ASSIGN_HINT = re.compile(r"[:=]")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
# whole runs of either base64 alphabet
_KEYS = (re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}={0,2}"),
         re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{32,}={0,2}"))
# words as they stand in paths: no chance run of a key has only such parts
_PATH_PART = re.compile(r"(?:[0-9]{1,8}|(?:[A-Z]?[a-z]+|[A-Z]{1,5})(?:[A-Z][a-z]+)*[0-9]{0,4})?")
_USER = re.compile(r"""(?:user(?:name)?|login|account|client_id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})""",
                   re.IGNORECASE | re.ASCII)
_ENDPOINT = re.compile(r"[a-z][a-z0-9+.-]{1,20}://[^\s\"'<>]+")
_BLANK_LINE = re.compile(r"\n[\x20\t\r]*\n")

_COMPLEMENTS = {
    "key": ("access", "user", "endpoint"),
    "user": ("assign", "access", "hex", "key"),
    "endpoint": ("assign", "access", "hex", "key"),
}

Span = tuple[int, int, str]  # start, end (code points, end exclusive), kind


def strong_spans(text: str) -> list[Span]:
    """Findings of the three base patterns, each leftmost and non-overlapping per kind."""
    found: list[Span] = []
    if _ASSIGN_HINT.search(text):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return found


def _is_path(run: str) -> bool:
    """Whether ``run`` reads as a path or a slug; empty parts come from separators at its ends or in a row."""
    parts = re.split("[/_-]", run)
    return sum(map(bool, parts)) > 1 and all(map(_PATH_PART.fullmatch, parts))


def weak_candidates(text: str, strong: list[Span]) -> list[Span]:
    """Parts that mean something only beside their complement; none wholly inside
    a strong finding. One that encloses a strong finding stays and may link to it."""
    found: list[Span] = []
    taken = sorted((s, e) for s, e, _ in strong)
    starts = [s for s, _ in taken]
    reach = list(accumulate((e for _, e in taken), max))

    def free(s: int, e: int) -> bool:
        k = bisect_right(starts, s)
        return k == 0 or reach[k - 1] < e

    runs = {(m.start(), m.end()) for pattern in _KEYS for m in pattern.finditer(text)
            if all(re.search(c, m[0]) for c in ("[0-9]", "[A-Z]", "[a-z]")) and not _is_path(m[0])}
    widest = -1
    for s, e in sorted(runs, key=lambda x: (x[0], -x[1])):
        if e > widest:
            widest = e
            if free(s, e):
                found.append((s, e, "key"))
    if _ASSIGN_HINT.search(text):
        found += [(m.start(1), m.end(1), "user") for m in _USER.finditer(text) if free(m.start(1), m.end(1))]
    if "://" in text:
        found += [(m.start(), m.end(), "endpoint") for m in _ENDPOINT.finditer(text) if free(m.start(), m.end())]
    return found


def linked(candidates: list[Span], strong: list[Span], text: str, scope: int = SCOPE_CHARS) -> list[Span]:
    """Candidates whose widened interval meets a complementary part's interval in the same scope."""
    if not candidates:
        return []
    breaks = [m.start() for m in _BLANK_LINE.finditer(text)]
    # of each kind: (paragraph, start) in order, the ends, and how far the parts up to there reach in their paragraph
    places: dict[str, list[tuple[int, int]]] = {}
    ends: dict[str, list[int]] = {}
    reach: dict[str, list[int]] = {}
    for s, e, kind in sorted(candidates + strong):
        at, far = places.setdefault(kind, []), reach.setdefault(kind, [])
        here = bisect_left(breaks, s)
        far.append(max(e, far[-1]) if at and at[-1][0] == here else e)
        at.append((here, s))
        ends.setdefault(kind, []).append(e)

    def meets(s: int, e: int, other: str) -> bool:
        # the parts of the paragraph that begin before the widened end; one must reach the widened start
        here, at = bisect_left(breaks, s), places.get(other, [])
        k = bisect_left(at, (here, e + scope))
        if not k or at[k - 1][0] != here or reach[other][k - 1] <= s - scope:
            return False
        if other in BASE:
            return True
        # a weak part counts only beside this one; weak parts of a kind do not overlap, so ends are in order, too
        if at[k - 1][1] >= e:
            return True
        k = bisect_right(ends[other], s, hi=k)
        return bool(k) and at[k - 1][0] == here and ends[other][k - 1] > s - scope

    return [(s, e, kind) for s, e, kind in candidates if any(meets(s, e, x) for x in _COMPLEMENTS[kind])]


def scan(text: str) -> list[Span]:
    """All findings, by start and then by kind as listed in ``KINDS``."""
    strong = strong_spans(text)
    found = strong + linked(weak_candidates(text, strong), strong, text)
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, spans`` with spans as array of (kind, start, end, value) for every row."""
    rows = plain(df, {id_col: id_col, "text": text_col})
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                         T.StructField("end", T.IntegerType()), T.StructField("value", T.StringType())])
    schema = T.StructType([rows.schema[0], T.StructField("spans", T.ArrayType(span))])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                ("value", pa.string())]))

    def run(batches):
        for b in slices(batches):
            out = [[{"kind": k, "start": s, "end": e, "value": t[s:e]} for s, e, k in scan(t)] for t in texts_of(b)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, type=arrow)], names=[id_col, "spans"])

    return rows.mapInArrow(run, schema)


def op4_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(read_table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def of_kind(kind):
        return lambda x: x["kind"] == kind

    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *[F.size(F.filter("spans", of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
