"""Secret scans over a ledger of content-addressed blobs, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from rtml.llm.common import broadcast_checked, prepare, stored


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches leftmost, without overlap; ``least`` characters of ``group`` are needed."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base kinds, in their listed order.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                   r"""([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Further kinds with unmistakable beginnings.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES
RULE_VERSION = "1"
SPAN = "array<struct<start:bigint,rank:int,end:bigint>>"
_SALTS = 16


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _placed(pieces: Column, at: Column, rank: int) -> Column:
    """Spans of ``pieces`` (``gap``, ``len``, ``good``) that follow each other from ``at`` on."""
    def add(acc, p):
        start = acc["at"] + p["gap"]
        end = start + p["len"]
        one = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(p["good"], F.concat(acc["out"], one))
                        .otherwise(acc["out"]).alias("out"))

    return F.aggregate(pieces, F.struct(at.alias("at"), F.array().cast(SPAN).alias("out")), add,
                       lambda acc: acc["out"].cast(SPAN))


def _in_blocks(pieces: Column, rank: int) -> Column:
    """``_placed`` in blocks of about the root of the number of pieces.

    An array that grows by one is copied each time; blocks keep these copies short.
    """
    width = F.ceil(F.sqrt(F.size(pieces))).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(pieces) / width).cast("int") - 1),
                         lambda b: F.slice(pieces, b * width + 1, width))
    none = F.array().cast("array<struct<at:bigint,"
                          "part:array<struct<gap:bigint,len:bigint,good:boolean>>>>")

    def add(acc, part):
        length = F.aggregate(part, F.lit(0).cast("long"), lambda n, p: n + p["gap"] + p["len"])
        return F.struct((acc["at"] + length).alias("at"), F.concat(acc["out"], F.array(F.struct(
            acc["at"].alias("at"), part.alias("part")))).alias("out"))

    starts = F.aggregate(blocks, F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")),
                         add, lambda acc: acc["out"])
    return F.flatten(F.transform(starts, lambda b: _placed(b["part"], b["at"], rank)))


def spans_of(text: Column, rule: Rule, rank: int) -> Column:
    """(``start``, ``rank``, ``end``) of each match, in code points, end exclusive.

    Positions follow from the lengths of the pieces between the matches. The text is cut once; the
    work beyond that grows with the power 1.5 of the number of matches.
    """
    none = F.array().cast(SPAN)
    gaps = F.split(text, rule.pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    sizes = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    found = F.zip_with(hits, sizes, lambda h, s: F.struct(
        F.length(h).cast("long").alias("len"), (F.length(s) >= rule.least).alias("good")))
    pieces = F.filter(F.zip_with(gaps, found, lambda g, f: F.struct(
        F.length(g).cast("long").alias("gap"), f["len"].alias("len"), f["good"].alias("good"))),
        lambda p: p["len"].isNotNull())
    return F.when(F.rlike(text, F.lit(rule.pattern)),
                  _bound(pieces, lambda p: _in_blocks(p, rank))).otherwise(none)


def all_spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    return F.sort_array(F.concat(*[spans_of(text, r, i) for i, r in enumerate(rules)]))


def read_ledger(spark, path: str, rule_version: str) -> DataFrame | None:
    """(``blob``, ``spans``) scanned under one rule version; None where there is no ledger yet."""
    try:
        ledger = spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return ledger.where(F.col("rule_version") == rule_version).select("blob", "spans") \
        .dropDuplicates(["blob"])


def scan_versions(docs: DataFrame, ledger_path: str, path_col: str = "doc_id",
                  text_col: str = "text", version_col: str | None = None,
                  rules: tuple[Rule, ...] = RULES,
                  rule_version: str = RULE_VERSION) -> DataFrame:
    """Findings of every stored version: path, version, ``blob`` and ``spans``, a row per input row.

    A blob is the SHA-256 of a text (null: empty), so copies and unchanged versions share one. Only
    blobs that the ledger lacks under ``rule_version`` are read and scanned, each once; their
    findings, empty ones included, are appended to the ledger, and findings are joined back to every
    path. Repeated rows keep a row each; null paths are kept; other columns are ignored. An empty
    table gives no rows. Texts move only if more than a counted number of rows are copies.
    """
    spark = docs.sparkSession
    prepare(spark)
    version = F.col(version_col).cast("string") if version_col else F.lit("")
    rows = docs.select(F.col(path_col).alias("path"), version.alias("version"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("content")) \
        .withColumn("blob", F.sha2("content", 256))
    addresses = stored(rows.select("path", "version", "blob"), "blobs")
    # rows not to read: copies of the one chosen row of a blob, and blobs that the ledger has
    place = F.xxhash64("path", "version")
    groups = addresses.groupBy("blob").agg(F.min(place).alias("one"), F.count(F.lit(1)).alias("m")) \
        .where("m > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    salted = addresses.withColumn("place", place) \
        .withColumn("salt", F.pmod(F.col("place"), F.lit(_SALTS)))
    skip = salted.join(groups, ["blob", "salt"]).where("place <> one").select("place", "blob")
    ledger = read_ledger(spark, ledger_path, rule_version)
    if ledger is not None:
        skip = skip.union(salted.join(ledger.select("blob"), "blob", "left_semi")
                          .select("place", "blob"))
    # a row is left out by its whole address, so no clash of hashes can leave a blob unread
    skip = stored(skip.select("place", F.unhex("blob").alias("bytes")).distinct(), "skip")
    unread = rows.withColumn("place", place).withColumn("bytes", F.unhex("blob")) \
        .join(broadcast_checked(skip), ["place", "bytes"], "left_anti")
    unread.select("blob", F.lit(rule_version).alias("rule_version"),
                  all_spans(F.col("content"), rules).alias("spans")) \
        .write.mode("append").parquet(ledger_path)
    found = read_ledger(spark, ledger_path, rule_version).where(F.size("spans") > 0) \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    joined = salted.join(found, ["blob", "salt"], "left")
    return joined.select(F.col("path").alias(path_col),
                         *([F.col("version").alias(version_col)] if version_col else []), "blob",
                         F.coalesce("spans", F.array().cast(SPAN)).alias("spans"))


def finding_digests(found: DataFrame, path_col: str = "doc_id",
                    rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts per base kind, digest of the base spans, and all spans as text."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    base = len(BASE_RULES)

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(rank):
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")

    counts = [count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE_RULES)]
    return found.select(F.col(path_col), *counts,
                        F.sha2(text(F.filter("spans", lambda s: s["rank"] < base)), 256)
                        .alias("base_sha256"), text(F.col("spans")).alias("spans"))
