"""Operator 7 [native]: secret scans with an incremental blob ledger.

Every version of every path is addressed by its content.  The ledger lists the
(blob, rule, version) triples that were scanned; a run scans only the triples that
are missing, once for each distinct blob, and joins the findings back to all paths
that hold it.  A new rule or a new version of one scans old blobs with
that rule alone.  :class:`Ledger` keeps both tables in a folder, a part for each finished run.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import drop_at_end, shared_folder


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern``; ``group`` of a match (0: all of it) must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    groups: int = 0
    least: int = 1
    base: bool = True
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: Fixed by the contract, in its order. A run of hex digits or of an access key is greedy, so its least length can stand in the pattern.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, groups=2, least=12),
    Rule("access", r"AKIA[A-Z0-9]{14,}", least=18),
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", base=False),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{20,}", base=False),
)
RULES = BASE + MORE


def _matches(text: Column, rule: Rule, rule_no: int) -> Column:
    """Array of (rule_no, no, gap, n, m): characters before each match since the last, of the match, and of its group."""
    # \G: without it the search would start anew at every place behind the last match
    lazily = F.lit(rf"(?s)\G(.*?)({rule.pattern})")
    part = lambda k: F.regexp_extract_all(text, lazily, F.lit(k))
    found = F.arrays_zip(part(1).alias("gap"), part(2).alias("all"), part(2 + rule.group).alias("value"))
    sized = F.transform(found, lambda x, i: F.struct(F.lit(rule_no).alias("rule_no"), i.alias("no"), F.length(x["gap"]).alias("gap"), F.length(x["all"]).alias("n"), F.length(x["value"]).alias("m")))
    return F.when(text.rlike(rule.pattern), sized)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blobs(blob, text, todo)`` to ``(blob, kind, rule_no, begin, end)``; todo lists the rules to run, null for all."""
    parts = []
    for k, rule in enumerate(rules):
        wanted = F.col("todo").isNull() | F.array_contains("todo", rule.name)
        parts.append(F.when(wanted, _matches(F.col("text"), rule, k)))
    none = F.array().cast("array<struct<rule_no:int,no:int,gap:int,n:int,m:int>>")
    each = blobs.select("blob", F.explode(F.concat(*[F.coalesce(p, none) for p in parts])).alias("x")).select("blob", "x.*").distinct()
    before = Window.partitionBy("blob", "rule_no").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(before).cast("long"))
    least = F.element_at(F.array(*[F.lit(r.least) for r in rules]), F.col("rule_no") + 1)
    kind = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("rule_no") + 1)
    return each.where(F.col("m") >= least).select("blob", kind.alias("kind"), "rule_no", (F.col("end") - F.col("n")).alias("begin"), "end")


def versions_of(docs: DataFrame, path_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(path_col).alias("path"), F.sha2(F.encode(text, "UTF-8"), 256).alias("blob"), text.alias("text"))


def unseen_blobs(paths: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, path, todo), one row for each blob of ``paths(path, blob)`` that some rule has not seen, with one of its paths; todo lists the rules to run, null for all."""
    first = paths.groupBy("blob").agg(F.min("path").alias("path"))
    if ledger is None:
        return first.withColumn("todo", F.lit(None).cast("array<string>"))
    names = F.array(*[F.lit(r.name) for r in rules])
    seen = ledger.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    return first.join(seen, "blob", "left").withColumn("todo", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))).where(F.size("todo") > 0).drop("seen")


def with_text(first: DataFrame, versions: DataFrame) -> DataFrame:
    """(blob, text, todo). Repeated rows may give a blob twice; its matches are made distinct before they are placed."""
    # Joined on blob and path as one key: by the blob alone, all paths of a very common blob would meet in one task.
    whole = F.concat_ws(":", "blob", F.coalesce(F.concat(F.lit("p"), F.col("path").cast("string")), F.lit("")))
    return versions.withColumn("whole", whole).join(first.select(whole.alias("whole"), "todo"), "whole").select("blob", "text", "todo")


def scanned_pairs(first: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The ledger's new rows (blob, rule)."""
    return first.select("blob", F.explode(F.coalesce("todo", F.array(*[F.lit(r.name) for r in rules]))).alias("rule"))


def scan_secrets(docs: DataFrame, ledger: DataFrame | None = None, known: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, path_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Findings by path, findings by blob, and the new ledger rows.

    ``ledger(blob, rule)`` and ``known(blob, kind, rule_no, begin, end)`` are what
    earlier runs returned; blob findings are the known ones and the new ones.  By path: (path, blob,
    findings), an array of (begin, rule_no, end, kind) in order, begin and end in code points, end exclusive.

    A null text is an empty blob; a text is scanned whole, however long.  Null and repeated paths are paths like any
    other; repeated rows give repeated rows; an empty table gives empty ones.  Other columns, of any name, are ignored.
    """
    versions = versions_of(docs, path_col, text_col)
    first = unseen_blobs(versions.select("path", "blob"), ledger, rules)
    found = scan_blobs(with_text(first, versions), rules)
    if known is not None:
        found = found.unionByName(known)
    return by_path(versions, found), found.distinct(), scanned_pairs(first, rules)


def by_path(versions: DataFrame, found: DataFrame) -> DataFrame:
    """Findings of all blobs, joined back to the paths; the few blobs with findings meet the paths, so a very common one is a skewed join, not a skewed group."""
    by_blob = found.groupBy("blob").agg(F.array_sort(F.collect_set(F.struct("begin", "rule_no", "end", "kind"))).alias("findings"))
    joined = versions.select("path", "blob").join(by_blob, "blob", "left")
    return joined.select("path", "blob", F.coalesce("findings", F.array().cast("array<struct<begin:bigint,rule_no:int,end:bigint,kind:string>>")).alias("findings"))


class Ledger:
    """Scanned (blob, rule) pairs and findings in a folder that the cluster shares.

    Each run writes a part of its own and names it in ``parts`` last, so what a
    broken run has left behind is never read, and is scanned again.
    """

    SCANNED, FOUND = "blob string, rule string", "blob string, kind string, rule string, begin long, end long"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def parts(self) -> list[str]:
        try:
            rows = self.spark.read.schema("part string").json(f"{self.folder}/parts").collect()  # one row a run
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(r["part"] for r in rows)

    def read(self, table: str, schema: str) -> DataFrame | None:
        paths = [f"{self.folder}/{part}/{table}" for part in self.parts()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else None

    def scan(self, docs: DataFrame, rules: tuple[Rule, ...] = RULES, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Scan what the ledger lacks, add it, and return the findings of all paths by the rules given, as :func:`scan_secrets` does."""
        versions, part = versions_of(docs, path_col, text_col), uuid.uuid4().hex
        # paths and what is to scan are worked out once and written; texts are read again for the scan alone
        versions.select("path", "blob").write.parquet(f"{self.folder}/{part}/paths")
        paths = self.spark.read.parquet(f"{self.folder}/{part}/paths")
        unseen_blobs(paths, self.read("scanned", self.SCANNED), rules).write.parquet(f"{self.folder}/{part}/first")
        first = self.spark.read.parquet(f"{self.folder}/{part}/first")
        named = F.element_at(F.array(*[F.lit(r.name) for r in rules]), F.col("rule_no") + 1).alias("rule")
        scan_blobs(with_text(first, versions), rules).select("blob", "kind", named, "begin", "end").distinct().write.parquet(f"{self.folder}/{part}/found")
        names = F.array(*[F.lit(r.name) for r in rules])
        scanned_pairs(first, rules).write.parquet(f"{self.folder}/{part}/scanned")
        self.spark.range(1).select(F.lit(part).alias("part")).coalesce(1).write.mode("append").json(f"{self.folder}/parts")
        number = F.array_position(names, F.col("rule")).cast("int") - 1
        found = self.read("found", self.FOUND).select("blob", "kind", number.alias("rule_no"), "begin", "end").where("rule_no >= 0")
        return by_path(paths, found)


def _joined(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["begin"], x["end"])), ",")


def op7_secrets(spark, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/secret-ledger-{uuid.uuid4().hex}"
    drop_at_end(spark, folder)  # a query's ledger is its own; one that is kept lies where its user puts it
    ledger = Ledger(spark, folder)
    paths = ledger.scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("findings", lambda x: x["rule_no"] < len(BASE))
    digest = F.sha2(F.encode(_joined(base), "UTF-8"), 256)
    return paths.select(F.col("path").alias("doc_id"), *[n(r.kind) for r in BASE], digest.alias("base_sha256"), _joined(F.col("findings")).alias("spans"))


def _sql() -> str:
    each = " UNION ALL ".join(
        f"SELECT rid, {k} AS no, '{r.kind}' AS kind, unnest(regexp_extract_all(t, '(?s)(.*?)({p})', 1)) AS gap, unnest(regexp_extract_all(t, '(?s)(.*?)({p})', 2)) AS hit, "
        f"unnest(regexp_extract_all(t, '(?s)(.*?)({p})', {2 + r.group})) AS v, unnest(range(len(regexp_extract_all(t, '(?s)(.*?)({p})', 2)))) AS i, {r.least} AS least FROM d"
        for k, r in enumerate(RULES)
        for p in [r.pattern.replace("'", "''")]
    )
    one = "string_agg(kind || ':' || (e - length(hit)) || ':' || e, ',' ORDER BY e - length(hit), no)"
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({each}),
s AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY rid, no ORDER BY i) AS e FROM m),
g AS (SELECT rid, {counts}, {one} FILTER (no < {len(BASE)}) AS base, {one} AS spans FROM s WHERE length(v) >= least GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)
"""


ORACLE_SQL = _sql()
