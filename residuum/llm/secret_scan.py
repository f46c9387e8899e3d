"""Secret scanning with an incremental blob ledger.

Every version of a text is a blob, addressed by the SHA-256 of its content. A ledger holds
which blob has been scanned by which rule version, and what was found. A run scans only the
(blob, rule version) pairs the ledger lacks, each blob once however many paths hold it, and
joins the findings back to every path.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residuum.llm.common import free_name, quoted


@dataclass(frozen=True)
class Rule:
    """A pattern; ``group`` must have ``least`` characters or the match is dropped.

    A new ``version`` makes every blob unseen to this rule.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    version: int = 1


#: The base kinds, then formats that issuers of credentials publish.
BASE_KINDS = ("assign", "access", "hex")
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 32),
    Rule("private_key", r"-----BEGIN (?:[A-Z]{1,12} ){0,3}PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}"),
    Rule("url_password", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/@]{4,128}@"),
)
#: A ledger is a table of these rows; a blob has a row for each run that has scanned it.
LEDGER = "blob string, found array<struct<rule:string,version:int,spans:array<struct<first:int,last:int>>>>"
_SPAN = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))
_FINDINGS = T.StructType([T.StructField("rule", T.StringType()), T.StructField("version", T.IntegerType()), T.StructField("spans", _SPAN)])
_ARROW = pa.list_(pa.struct([("rule", pa.string()), ("version", pa.int32()), ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))]))


def spans_of(text: str, rule: Rule, compiled: re.Pattern) -> list[dict]:
    """Leftmost matches that do not overlap, in code points; those too short are dropped."""
    found = compiled.finditer(text)
    return [{"first": m.start(), "last": m.end()} for m in found if m.end(rule.group) - m.start(rule.group) >= rule.least]


def with_blob(docs: DataFrame, text_col: str, blob: str) -> DataFrame:
    return docs.withColumn(blob, F.sha2(F.coalesce(F.col(quoted(text_col)), F.lit("")), 256))


def scan(docs: DataFrame, *, text_col: str = "text", ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows (blob, found): for each blob its unseen pairs of rule and version, also without a find.

    A null text is an empty blob. Copies of a text, repeated rows among them, are one blob
    and are scanned once. An empty table gives no rows. Append the result to the ledger.
    """
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    blobs = docs.select(F.sha2(text, 256).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    wanted = F.array(*(F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules))
    if ledger is None:
        blobs = blobs.withColumn("todo", wanted)
    else:
        seen = ledger.select("blob", F.inline("found")).groupBy("blob").agg(F.collect_set(F.struct("rule", "version")).alias("seen"))
        none = F.array().cast("array<struct<rule:string,version:int>>")
        todo = F.array_except(wanted, F.coalesce("seen", none))
        blobs = blobs.join(seen, "blob", "left").select("blob", "text", todo.alias("todo")).where(F.size("todo") > 0)

    def run(batches):
        own = {r.kind: (r, re.compile(r.pattern, re.ASCII)) for r in rules}
        for batch in batches:
            out = []
            for text, todo in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                out.append([{**pair, "spans": spans_of(text, *own[pair["rule"]])} for pair in todo])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, _ARROW)], ["blob", "found"])

    return blobs.mapInArrow(run, T.StructType([T.StructField("blob", T.StringType()), T.StructField("found", T.ArrayType(_FINDINGS))]))


def scan_into(docs: DataFrame, path: str, *, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger stored at ``path``, after what ``docs``, a further version of a table or all
    of them, adds to it. A run that fails leaves no part of its rows; one that finds nothing new adds none."""
    spark = docs.sparkSession
    try:
        ledger = spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        ledger = None
    scan(docs, text_col=text_col, ledger=ledger, rules=rules).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def findings(docs: DataFrame, ledger: DataFrame, *, text_col: str = "text", rules: tuple[Rule, ...] = RULES, blob: str = "blob", found: str = "found") -> DataFrame:
    """Each path (row of ``docs``) with its blob and, in order of place, all spans of the current rules.

    Blobs without a find have an empty list. Columns of ``docs`` stay; should one be named
    ``blob`` or ``found``, the new ones, which are the last, get underscores in front.
    """
    blob = free_name(docs.columns, blob)
    found = free_name([*docs.columns, blob], found)
    key = free_name([*docs.columns, blob, found], "key")
    current = F.lit(False)
    for r in rules:
        current = current | ((F.col("rule") == r.kind) & (F.col("version") == r.version))
    order = {r.kind: i for i, r in enumerate(rules)}
    rank = F.coalesce(*(F.when(F.col("rule") == k, F.lit(i)) for k, i in order.items()))
    each = ledger.where(F.exists("found", lambda x: F.size(x["spans"]) > 0)).select("blob", F.inline("found")).where(current & (F.size("spans") > 0)).select("blob", rank.alias("rank"), "rule", F.inline("spans"))
    own = each.groupBy(F.col("blob").alias(key)).agg(F.array_sort(F.collect_set(F.struct("first", "rank", "last", "rule"))).alias(found))
    paths = with_blob(docs, text_col, blob)
    return paths.join(own, F.col(blob) == F.col(key), "left").drop(key).withColumn(found, F.coalesce(F.col(found), F.array().cast("array<struct<first:int,rank:int,last:int,rule:string>>")))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""
    name = found.columns[-1]
    base = F.filter(name, lambda x: x["rule"].isin(*BASE_KINDS))
    as_text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["rule"], x["first"].cast("string"), x["last"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter(name, lambda x: x["rule"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(F.col(quoted(id_col)).alias("doc_id"), *map(count, BASE_KINDS), F.sha2(as_text(base), 256).alias("base_sha256"), as_text(F.col(name)).alias("spans"))
