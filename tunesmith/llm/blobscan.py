"""Secret scans over an incremental blob ledger.

Every version of every text is a blob named by its SHA-256.  The ledger holds
one row per scanned (blob, rule, rule version) with the spans found, also when
there are none.  A run scans only pairs that the ledger lacks: a text that
comes back under another path, or in a later run, is not read by any rule
again; a new rule, or a new version of one, is run over known blobs alone.
Findings are then joined back to all paths.

Scale and recovery: paths travel as digests; a blob's text is shuffled once.
The ledger is appended in one Spark write per run, so a failed run leaves no
half of it.  A blob shared by a third of all paths is one ledger row and a
hot key of a plain join, which adaptive execution splits.

Defined results: null text is the empty blob; repeated rows are paths of
their own; an empty table gives an empty result; clashing input columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import prepare
from tunesmith.session import scratch_path


class Rule(NamedTuple):
    """``hints``: lower-case parts one of which every match holds; ``group``
    and ``least``: which group has to have how many characters."""

    kind: str
    version: int
    pattern: str
    hints: tuple = ()
    group: int = 0
    least: int = 0
    any_case: bool = False


#: in the order in which spans of equal start are listed
RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
         r"([A-Za-z0-9+/_.=-]+)", ("passw", "secret", "token", "api"), 2, 6, True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", ("akia",), 0, 20),
    # the runs that the 24-character limit keeps
    Rule("hex", 1, r"[0-9a-f]{24,}", (), 0, 24),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", ("-----begin",)),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", ("eyj",)),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", ("xox",)),
)
BASE = ("assign", "access", "hex")
_ENTRY = ("blob binary, rule string, version int, "
          "spans array<struct<start:bigint,stop:bigint>>")


def spans_of(text: str, low: str, rule: Rule, compiled: re.Pattern) -> list[dict]:
    if rule.hints and not any(h in low for h in rule.hints):
        return []
    return [{"start": m.start(), "stop": m.end()} for m in compiled.finditer(text)
            if len(m[rule.group]) >= rule.least]


def _scanner(rules: tuple):
    entry = pa.schema([("blob", pa.binary()), ("rule", pa.string()), ("version", pa.int32()),
                       ("spans", pa.list_(pa.struct([("start", pa.int64()),
                                                     ("stop", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = {r.kind: (r, re.compile(r.pattern, re.A | (re.I if r.any_case else 0)))
                 for r in rules}
        for batch in batches:
            blobs, texts = batch.column("blob").to_pylist(), batch.column("text")
            wanted = batch.column("rules").to_pylist()
            out = {"blob": [], "rule": [], "version": [], "spans": []}
            for blob, text, kinds in zip(blobs, texts, wanted):
                text = text.as_py()
                low = text.lower()
                for kind in kinds:
                    rule, compiled = ready[kind]
                    out["blob"].append(blob)
                    out["rule"].append(kind)
                    out["version"].append(rule.version)
                    out["spans"].append(spans_of(text, low, rule, compiled))
            yield pa.RecordBatch.from_pydict(out, entry)
    return run


def update_ledger(blobs: DataFrame, ledger: str, rules: tuple = RULES) -> DataFrame:
    """Scan what the ledger at folder ``ledger`` lacks, append it, and return
    the ledger's entries of the current rule versions.

    ``blobs`` has (blob, text); equal blobs may stand more than once.
    """
    spark = blobs.sparkSession
    current = [(r.kind, r.version) for r in rules]
    have = spark.read.schema(_ENTRY).parquet(ledger) if _exists(spark, ledger) else None
    asked = blobs.select("blob").distinct()
    rule_rows = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.lit(v).alias("version"))
                                    for k, v in current]))
    once = blobs.dropDuplicates(["blob"])
    if have is None:
        todo = once.withColumn("rules", F.array(*[F.lit(k) for k, _ in current]))
    else:
        pairs = asked.select("blob", rule_rows.alias("r")).select("blob", "r.rule", "r.version")
        missing = (pairs.join(have.select("blob", "rule", "version"),
                              ["blob", "rule", "version"], "left_anti")
                   .groupBy("blob").agg(F.sort_array(F.collect_set("rule")).alias("rules")))
        todo = once.join(missing, "blob")
    found = todo.select("blob", "text", "rules").mapInArrow(_scanner(rules), _ENTRY)
    found.write.mode("append").parquet(ledger)
    now = F.lit(False)
    for kind, version in current:
        now = now | ((F.col("rule") == kind) & (F.col("version") == version))
    return spark.read.schema(_ENTRY).parquet(ledger).filter(now)


def _exists(spark, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _count(kind: str) -> Column:
    return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 ledger: str | None = None, rules: tuple = RULES) -> DataFrame:
    """Per path: id, counts of the base kinds, base_sha256 and all spans.

    ``ledger`` is the folder of earlier runs; None starts a new one.
    """
    spark = docs.sparkSession
    prepare(spark)
    ledger = ledger or scratch_path(spark, "ledger")
    text = F.coalesce(F.col(text_col), F.lit(""))
    blob = F.unhex(F.sha2(text, 256))
    entries = update_ledger(docs.select(blob.alias("blob"), text.alias("text")), ledger, rules)
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    each = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), order[F.col("rule")].alias("rank"),
        s["stop"].alias("stop"), F.col("rule").alias("kind")))
    # an entry appended twice (two runs at once) counts once
    per_rule = entries.select("blob", "rule", each.alias("spans")).dropDuplicates(["blob", "rule"])
    per_blob = (per_rule.filter(F.size("spans") > 0).groupBy("blob")
                .agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("all")))
    named = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
    found = F.coalesce(F.col("all"), F.array().cast(
        "array<struct<start:bigint,rank:int,stop:bigint,kind:string>>"))
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    joined = docs.select(F.col(id_col).alias("__id"), blob.alias("blob")).join(
        per_blob, "blob", "left").withColumn("found", found)
    return joined.select(
        F.col("__id").alias(id_col),
        *[_count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(named(base), 256).alias("base_sha256"), named(F.col("found")).alias("spans"))
