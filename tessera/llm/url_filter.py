"""URL filter: host-suffix and path-prefix expressions against a rule list.

Every URL is expanded into expressions ``host suffix + path prefix`` (only
shapes that some rule has), each expression is hashed, rules are found by
an equi-join on the first four bytes of the digest, and a hit counts only
if the whole digests agree. Of the rules that fit, the longest wins.

Defined cases: a null url or one without ``://`` has empty host and path,
fits no rule and gets the default verdict; repeated rows come back as often
as they went in; an empty table gives an empty result; a null id is kept;
urls of any length are judged whole; further columns are left out.
Equal-length rules: the longer host wins, then ``block``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import plain, read_table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # "allow" or "block"


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)
DEFAULT_VERDICT = "allow"

PREFIX_HEX = 8          # 4 bytes of the digest
BROADCAST_RULES = 100_000  # rule rows (about 150 bytes each) that may be broadcast
SALTS = 64


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.regexp_replace(rest, r"^[^/?#]*", ""), r"^[^?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), path


def rule_frame(spark, rules: Sequence[Rule]) -> DataFrame:
    return spark.createDataFrame([(r.host, r.path, r.verdict) for r in rules],
                                 "host string, path string, verdict string")


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = DEFAULT_VERDICT) -> DataFrame:
    """``id, url, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` has ``host, path, verdict``. One shuffle of (id, url); the
    rules are broadcast while they number at most ``BROADCAST_RULES``,
    beyond that both sides are hashed by (prefix, salt) with the rules
    repeated per salt, so a rule that most URLs hit is spread.
    """
    shape = rules.agg(
        F.count("*").alias("n"),
        F.max(F.size(F.split("host", r"\."))).alias("labels"),
        F.array_sort(F.collect_set(F.length("path"))).alias("lengths"),
    ).first()
    labels, lengths = shape["labels"] or 0, shape["lengths"] or []

    digest = F.sha2(F.concat("host", "path"), 256)
    known = rules.select(
        F.substring(digest, 1, PREFIX_HEX).alias("prefix"), digest.alias("rule_digest"),
        F.struct(F.length(F.concat("host", "path")).alias("len"), F.length("host").alias("host_len"),
                 (F.col("verdict") == "block").cast("int").alias("blocks"),
                 F.concat("host", "path").alias("rule"), F.col("verdict").alias("verdict")).alias("hit"),
    )

    host, path = host_and_path(F.col("url"))
    rows = (plain(pages, {"id": id_col, "url": url_col})
            .groupBy("id", "url").agg(F.count("*").alias("copies"))
            .withColumns({"host": host, "path": path}))
    parts = F.split("host", r"\.")
    # the last 1..labels labels, and prefixes as long as some rule's path
    suffixes = F.transform(
        F.filter(F.sequence(F.lit(1), F.lit(max(labels, 1))), lambda n: n <= F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n))
    urls = rows.withColumn("suffix", F.explode_outer(suffixes)).withColumn("start", F.explode_outer(prefixes))
    digests = F.sha2(F.concat("suffix", "start"), 256)
    urls = urls.withColumn("digest", digests).withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))

    if shape["n"] <= BROADCAST_RULES:
        joined = urls.join(F.broadcast(known), "prefix", "left")
    else:
        salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = urls.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int")) \
                     .join(salted, ["prefix", "salt"], "left")
    confirmed = F.when(F.col("digest") == F.col("rule_digest"), F.col("hit"))
    best = joined.groupBy("id", "url", "copies", "host", "path").agg(F.max(confirmed).alias("best"))
    return (best.withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
            .select(F.col("id").alias(id_col), F.col("url").alias(url_col), "host", "path",
                    F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def op1_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return filter_urls(pages, rule_frame(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = f"""
WITH r(host, path, verdict) AS (
  VALUES {", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)}
), u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), s AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path,
         row_number() OVER () AS rid
  FROM u
), hits AS (
  SELECT s.rid, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY s.rid ORDER BY length(r.host || r.path) DESC) AS k
  FROM s JOIN r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
)
SELECT s.page_id, s.host, s.path, h.rule, coalesce(h.verdict, '{DEFAULT_VERDICT}') AS verdict
FROM s LEFT JOIN hits h ON h.rid = s.rid AND h.k = 1
"""
