"""Personal data by weak supervision: voting labelers, EM, a span classifier.

Candidate spans come from patterns: four base kinds (email, ip, card, phone)
and further forms that are personal data only sometimes (``SOFT``). Three
labelers vote on each candidate (1 yes, 0 no, -1 abstain): a strict pattern,
a gazetteer (top-level domains, calling codes, issuer prefixes, reserved
address blocks, bank countries) and the context (cue words nearby). The
votes of all documents are counted per pattern of votes; expectation
maximisation over that table (its size is fixed by the labelers) estimates
each labeler's reliability, and a logistic span classifier is trained on the
resulting probabilities. Base spans stay as they are; further candidates are
reported where the classifier says so.

The main path is DataFrame expressions only: one pass over the texts, whose
narrow candidate rows are written once and then counted and judged.

A pattern's matches come from ``regexp_extract_all`` and the gaps between
them from ``split`` by the same pattern; the lengths of both add up to the
places. They are added up in blocks of ``BLOCK`` matches, and a context is read
from the ends of the matches and gaps of its block, so a text costs about as
much as it is long and has matches. The patterns are written without
backtracking over long runs.

Defined cases: a null text counts as empty and has no span; texts of any
length are read whole; repeated rows and null ids pass through; further
columns are left out, whatever their names; spans that begin together are
ordered by kind; a probability of exactly ``ACCEPT`` is reported; an empty
table gives an empty result, and without any soft candidate nothing is trained.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, plain, read_table, text_or_empty

# Base patterns. An email's local part can only begin where a run of its
# characters does, or right after the match before (\G).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SOFT = {
    "masked_email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}"
                    r"(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{1,63}){1,4}",
    "local_phone": r"(?<![0-9A-Za-z+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z.-])",
    "id_number": r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z.-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
}
KINDS = (*BASE, *SOFT)
# a text without this has no match of the kind
HINT = {"email": "@", "phone": "+"}

# labelers
_STRICT = {
    "email": r"^[A-Za-z0-9][^@]*@[A-Za-z0-9].*\.[A-Za-z]{2,}$",
    "ip": r"^(0|[1-9][0-9]{0,2})(\.(0|[1-9][0-9]{0,2})){3}$",
    "card": r"^[0-9]{13,19}$|^[0-9]{4}([ -][0-9]{4}){2,3}([ -][0-9]{1,4})?$",
    "phone": r"^\+[1-9].*[0-9]{4}$",
    "masked_email": r"(\.|dot[)\]]) ?[A-Za-z]{2,}$",
    "local_phone": r"^\(?[2-9]",
    "id_number": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
    "iban": r"^[A-Z]{2}[0-9]{2}[A-Z0-9 ]{11,}$",
}
_GAZETTEER = {
    "email": r"\.(com|org|net|edu|gov|io|info|biz|de|fr|es|it|uk|nl|eu|us|ca|ch|at|be|pt|pl|se)$",
    "ip": r"^(?!0\.|10\.|127\.|169\.254\.|192\.168\.|22[4-9]\.|2[3-9][0-9]\.)",
    "card": r"^(4|5[1-5]|2[2-7]|3[47]|35|6)",
    "phone": r"^\+(1|20|27|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])",
    "masked_email": r"(com|org|net|edu|gov|io|info|de|fr|es|it|uk|nl|eu|us|ca)$",
    "local_phone": r"^\(?[2-9][0-8][0-9]",
    "id_number": None,
    "iban": r"^(AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|GR|HU|IE|IT|LU|NL|NO|PL|PT|SE)",
}
_CUE = (r"(?i)\b(e-?mail|mail|contact|write|phone|tel|call|fax|mobile|ip|host|server|address|card|visa|pay(ment)?"
        r"|credit|iban|account|bank|ssn|social|security|passport|id)\b")
_CONTEXT_BEFORE, _CONTEXT_AFTER = 40, 20

# features of the span classifier, with few values each; it does not see the votes
_CUES = {
    "contact": "e-?mail|mail|contact|write|phone|tel|call|fax|mobile",
    "network": "ip|host|server|address",
    "payment": "card|visa|pay(ment)?|credit|iban|account|bank",
    "identity": "ssn|social|security|passport|id",
}
VOTES = ("strict", "gazetteer", "context")
FEATURES = ("kind", "length", "digits", "left", "right", "cue")
SPANS = ("array<struct<kind:string,s:int,e:int,v:string,strict:int,gazetteer:int,context:int,"
         "length:int,digits:int,left:string,right:string,cue:string>>")

EM_ROUNDS = 60
ACCEPT = 0.5
# spans that are placed together: running sums and contexts are taken inside a block
BLOCK = 64


def _short(v: str) -> str:
    """``v`` without its middle: the ends that the context of a neighbouring span can reach."""
    return (f"if(length({v}) > {_CONTEXT_BEFORE + _CONTEXT_AFTER}, "
            f"concat(left({v}, {_CONTEXT_AFTER}), right({v}, {_CONTEXT_BEFORE})), {v})")


def _in_blocks(items: str) -> str:
    """The array column in slices of ``BLOCK``; null for none. ``items`` is named twice, so it is computed once."""
    return f"if(size({items}) > 0, transform(sequence(1, size({items}), {BLOCK}), at -> slice({items}, at, {BLOCK})), null)"


def _items(kind: str) -> Column:
    """Each match ``v`` with the length of the gap before it and the ends of both; the text's tail has a null ``v``."""
    gap, hit = _short(f"x.gaps_{kind}"), _short(f"x.hits_{kind}")
    return F.expr(f"""transform(arrays_zip(gaps_{kind}, hits_{kind}), x -> named_struct(
        'gap', length(x.gaps_{kind}), 'v', x.hits_{kind}, 'ends', concat({gap}, coalesce({hit}, '')),
        'skip', length({gap})))""")


def _blocks(kind: str) -> Column:
    """``array<struct<items, ends, n>>``: a block, the ends of its items in a row, its whole length."""
    return F.expr(f"""transform({_in_blocks(f"items_{kind}")}, b -> named_struct(
        'items', b, 'ends', array_join(transform(b, x -> x.ends), ''),
        'n', aggregate(b, 0, (n, x) -> n + x.gap + coalesce(length(x.v), 0))))""")


def _starts(kind: str) -> Column:
    """Where each block begins in its text."""
    return F.expr(f"""aggregate(blocks_{kind}, named_struct('p', 0, 'a', cast(array() as array<int>)),
        (acc, b) -> named_struct('p', acc.p + b.n, 'a', concat(acc.a, array(acc.p))), acc -> acc.a)""")


def _lefts(kind: str) -> Column:
    """The end of the block before each; a block of ``BLOCK`` matches is longer than a context."""
    return F.expr(f"""slice(concat(array(''), transform(blocks_{kind}, b -> right(b.ends, {_CONTEXT_BEFORE}))),
        1, size(blocks_{kind}))""")


def _rights(kind: str) -> Column:
    """The beginning of the block after each."""
    return F.expr(f"""concat(slice(transform(blocks_{kind}, b -> left(b.ends, {_CONTEXT_AFTER})),
        2, size(blocks_{kind})), array(''))""")


def _placed(kind: str) -> Column:
    """Of each block its ``ends`` with those around it, and ``spans``: places in the
    text (``s, e``, code points, end exclusive) and among the ends (``at, to``)."""
    return F.expr(f"""transform(arrays_zip(blocks_{kind}, starts_{kind}, lefts_{kind}, rights_{kind}), b -> named_struct(
        'ends', concat(b.lefts_{kind}, b.blocks_{kind}.ends, b.rights_{kind}),
        'spans', aggregate(b.blocks_{kind}.items,
            named_struct('p', b.starts_{kind}, 'q', length(b.lefts_{kind}),
                         'a', cast(array() as array<struct<s:int,e:int,v:string,at:int,to:int>>)),
            (acc, x) -> named_struct(
                'p', acc.p + x.gap + coalesce(length(x.v), 0), 'q', acc.q + length(x.ends),
                'a', concat(acc.a, array(named_struct(
                    's', acc.p + x.gap, 'e', acc.p + x.gap + coalesce(length(x.v), 0), 'v', x.v,
                    'at', acc.q + x.skip, 'to', acc.q + length(x.ends))))),
            acc -> acc.a)))""")


def _luhn(digits: Column) -> Column:
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        return ~v.rlike(r"(^|\.)0*([1-9][0-9]{3,}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])(\.|$)")
    if kind == "card":
        digits = F.regexp_replace(v, "[ -]", "")
        return F.length(digits).between(13, 19) & F.when(F.length(digits).between(13, 19), _luhn(digits))
    if kind == "phone":
        return F.length(F.regexp_replace(v, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _checked(kind: str) -> Column:
    """``_placed`` without the matches that fail."""
    return F.transform(f"placed_{kind}", lambda b: F.struct(b["ends"].alias("ends"), F.filter(
        b["spans"], lambda x: x["v"].isNotNull() & _valid(kind, x["v"])).alias("spans")))


def _vote(pattern: str | None) -> str:
    return "-1" if pattern is None else f"int(c.v rlike r'{pattern}')"


def _class(c: str) -> str:
    """Class of the character beside a span."""
    return rf"case when {c} rlike r'^[0-9A-Za-z]$' then 'word' when {c} rlike r'^\S$' then 'mark' else 'blank' end"


def _found(kind: str) -> Column:
    """Spans of ``kind`` by start, with votes and features from the text right around them; an empty array for none."""
    cues = " ".join(rf"when c.before rlike r'(?i)\b({words})\b' then '{name}'" for name, words in _CUES.items())
    return F.expr(f"""coalesce(flatten(transform(checked_{kind}, b -> transform(
        transform(b.spans, x -> named_struct('x', x,
            'before', substring(b.ends, greatest(x.at - {_CONTEXT_BEFORE}, 0) + 1, least(x.at, {_CONTEXT_BEFORE})),
            'after', substring(b.ends, x.to + 1, {_CONTEXT_AFTER}), 'v', x.v)),
        c -> named_struct(
            'kind', '{kind}', 's', c.x.s, 'e', c.x.e, 'v', c.v,
            'strict', {_vote(_STRICT[kind])},
            'gazetteer', {_vote(_GAZETTEER[kind])},
            'context', case when c.before rlike r'{_CUE}' or c.after rlike r'{_CUE}' then 1
                when c.before rlike '[0-9A-Za-z]$' or c.after rlike '^[0-9A-Za-z]' then 0 else -1 end,
            'length', int(least(length(c.v) div 8, 3)),
            'digits', int(length(regexp_replace(c.v, '[^0-9]', '')) * 2 div length(c.v)),
            'left', {_class("right(c.before, 1)")}, 'right', {_class("left(c.after, 1)")},
            'cue', case {cues} else 'none' end)))), cast(array() as {SPANS}))""")


def _ranges(kind: str) -> Column:
    """The spans of one kind in blocks, each with the range that it covers; an empty array for none."""
    return F.expr(f"""coalesce(transform({_in_blocks(f"found_{kind}")}, b -> named_struct(
        's', b[0].s, 'e', element_at(b, -1).e, 'spans', b)), cast(array() as array<struct<s:int,e:int,spans:{SPANS}>>))""")


def _meet(x: Column, y: Column) -> Column:
    return (x["s"] < y["e"]) & (y["s"] < x["e"])


def _apart(soft: str, base: str) -> Column:
    """Soft spans that meet no base span: blocks that meet first, then the spans of these."""
    near = F.transform(soft, lambda x: F.struct(
        x["spans"].alias("spans"),
        F.flatten(F.transform(F.filter(base, lambda y: _meet(x, y)), lambda y: y["spans"])).alias("near")))
    return F.flatten(F.transform(near, lambda b: F.filter(b["spans"], lambda x: ~F.exists(
        b["near"], lambda y: _meet(x, y)))))


def candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, found``: all candidate spans by kind and start, with votes and features; soft ones outside base spans."""
    rows = plain(df, {"id": id_col, "text": text_col}).withColumn("text", text_or_empty())
    empty = F.array().cast("array<string>")
    patterns = {**BASE, **SOFT}
    rows = rows.withColumns({
        f"hits_{k}": F.when(F.contains("text", F.lit(HINT[k])), F.regexp_extract_all("text", F.lit(p), F.lit(0)))
                      .otherwise(empty) if k in HINT else F.regexp_extract_all("text", F.lit(p), F.lit(0))
        for k, p in patterns.items()})
    rows = rows.withColumns({f"gaps_{k}": F.when(F.size(f"hits_{k}") > 0, F.split("text", p, -1))
                            for k, p in patterns.items()})
    for name, step in (("items", _items), ("blocks", _blocks)):
        rows = rows.select("id", *[step(k).alias(f"{name}_{k}") for k in patterns])
    around = (("starts", _starts), ("lefts", _lefts), ("rights", _rights))
    rows = rows.withColumns({f"{name}_{k}": step(k) for name, step in around for k in patterns})
    for name, step in (("placed", _placed), ("checked", _checked), ("found", _found)):
        rows = rows.select("id", *[step(k).alias(f"{name}_{k}") for k in patterns])
    rows = rows.select("id", F.concat(*[F.col(f"found_{k}") for k in BASE]).alias("base"),
                       F.concat(*map(_ranges, BASE)).alias("covered"), F.concat(*map(_ranges, SOFT)).alias("soft"))
    return rows.select("id", F.concat("base", _apart("soft", "covered")).alias("found"))


@dataclass(frozen=True)
class SpanModel:
    """Logistic weights of the features ``name=value``; empty where nothing was trained."""

    weights: dict[str, float]
    bias: float

    def accepts(self, x: Column) -> Column:
        if not self.weights:
            return F.lit(False)
        known = F.create_map(*[F.lit(v) for pair in self.weights.items() for v in pair])
        z = F.lit(self.bias)
        for name in FEATURES:
            key = F.concat(F.lit(f"{name}="), x[name].cast("string"))
            z = z + F.coalesce(F.try_element_at(known, key), F.lit(0.0))
        return z >= math.log(ACCEPT / (1 - ACCEPT))


def fit_spans(found: DataFrame) -> SpanModel:
    """EM over the counted votes, then the classifier on its probabilities.

    The counted table has a row for each combination of kind, votes and
    features that occurs: at most 8 x 27 x 4 x 3 x 3 x 3 x 5 at any size of input.
    """
    keys = (*FEATURES, *VOTES)
    table = (found.select(F.explode("found").alias("x"))
             .groupBy(*[f"x.{k}" for k in keys]).agg(F.count("*").alias("n")).orderBy(*keys).collect())
    if not any(r["kind"] in SOFT for r in table):
        return SpanModel({}, 0.0)
    n = np.array([r["n"] for r in table], float)
    votes = np.array([[r[v] for v in VOTES] for r in table])
    kinds = np.array([KINDS.index(r["kind"]) for r in table])
    posterior = reliabilities(n, votes, kinds)[0]
    features = [[f"{f}={r[f]}" for f in FEATURES] for r in table]
    names = sorted({f for row in features for f in row})
    place = {name: k for k, name in enumerate(names, 1)}
    x = np.zeros((len(table), len(names) + 1))
    x[:, 0] = 1
    for k, row in enumerate(features):
        x[k, [place[f] for f in row]] = 1
    w = np.zeros(x.shape[1])
    for _ in range(25):  # Newton steps of the ridge logistic fit to soft labels
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (n * (posterior - p)) - w
        hessian = (x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + np.eye(len(w))
        w = w + np.linalg.solve(hessian, gradient)
    return SpanModel(dict(zip(names, w[1:].tolist())), float(w[0]))


def reliabilities(n: np.ndarray, votes: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each vote pattern marks a true span, and P(vote | truth)
    per labeler, truth and vote (0, 1, abstain). Every kind has its own prior."""
    share = (votes == 1).sum(1) - (votes == 0).sum(1)
    posterior = 1 / (1 + np.exp(-share.astype(float)))
    table = np.zeros((votes.shape[1], 2, 3))
    for _ in range(EM_ROUNDS):
        for j in range(votes.shape[1]):
            for t, weight in enumerate((n * (1 - posterior), n * posterior)):
                counts = np.array([weight[votes[:, j] == v].sum() for v in (0, 1, -1)]) + 1.0
                table[j, t] = counts / counts.sum()
        prior = np.array([(1 + (n * posterior)[kinds == k].sum()) / (2 + n[kinds == k].sum())
                          for k in range(len(KINDS))])[kinds]
        like = np.stack([np.log(1 - prior), np.log(prior)], 1)
        for j in range(votes.shape[1]):
            column = np.where(votes[:, j] == -1, 2, votes[:, j])
            like += np.log(table[j][:, column]).T
        posterior = 1 / (1 + np.exp(np.clip(like[:, 0] - like[:, 1], -50, 50)))
    return posterior, table


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, spans``: array of (kind, s, e, v, votes) by kind and start for every row."""
    found = materialize(candidates(df, id_col, text_col), "pii-candidates")
    model = fit_spans(found)
    kept = F.filter("found", lambda x: x["kind"].isin(*BASE) | model.accepts(x))
    return found.select(F.col("id").alias(id_col), kept.alias("spans"))


def op6_pii(spark, sf_dir: str) -> DataFrame:
    found = find_pii(read_table(spark, sf_dir, "documents"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")

    def of_kind(kind: str):
        return lambda x: x["kind"] == kind

    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *[F.size(F.filter("spans", of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        (F.size("spans") > 0).alias("has_personal_data"))
