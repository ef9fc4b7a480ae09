"""Secret scans over an incremental blob ledger.

A version is a row with a text: a document, or one state of a file in a
history. Its blob is its content address, the SHA-256 of the text. The ledger
is two tables in the shared store: ``scans`` names every (blob, rule, rule
version) that was scanned, ``findings`` the spans that were found. ``ingest``
scans each blob once for the rules that the ledger does not have for it, and
appends; ``by_path`` joins the findings back to every row that holds the blob.
So a text that a thousand paths share is scanned once, a second run over the
same history scans nothing, and a rule of a new version is run over all blobs
while the others rest.

Everything is DataFrame functions. A rule's matches are the gaps between the
pieces of ``split`` and the strings of ``regexp_extract_all``; running sums of
both lengths give the spans, in code points.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.skew import join_unique
from ..session import delete_path, path_exists
from .common import borrowed, fresh, shared_path, written


@dataclass(frozen=True)
class Rule:
    """One kind of secret: leftmost non-overlapping matches of ``pattern`` whose
    ``group`` has ``least`` characters or more. Change the version with the rule."""
    name: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1


#: The base kinds, in their order. A run of a character class is
#: matched from its start to its end or not at all, so ``access`` and ``hex``
#: carry their least length in the pattern; a short value of ``assign`` is
#: matched and then dropped, with the characters that it took.
BASE = (
    Rule("assign", r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),
)
#: Further kinds.
MORE = (
    Rule("pem", r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----", 27),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
)
RULES = BASE + MORE


def spans(blobs: DataFrame, rules: tuple[Rule, ...] = RULES, wanted: str = "rules") -> DataFrame:
    """``blob, rule, version, start, end`` (code points, end exclusive) of all
    secrets in ``blobs`` (``blob``, ``text``, and the names of the rules to run)."""
    def matches(r: Rule) -> Column:
        text, pattern = F.col("text"), F.lit(r.pattern)
        hit = F.array_contains(wanted, r.name) & text.rlike(r.pattern)
        found = F.regexp_extract_all(text, pattern, F.lit(0))
        value = (lambda m: F.regexp_extract(m, r.pattern, r.group)) if r.group else (lambda m: m)
        return F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"),
            F.when(hit, F.transform(F.split(text, r.pattern, -1), F.length)).alias("gaps"),
            F.when(hit, F.transform(found, lambda m: F.struct(
                F.length(m).alias("length"), (F.length(value(m)) >= r.least).alias("valid")))).alias("found"))

    per_rule = blobs.select("blob", F.inline(F.array(*[matches(r) for r in rules]))).where("found IS NOT NULL")
    each = per_rule.select("blob", "rule", "version", "gaps", F.posexplode("found").alias("k", "m")).select(
        "blob", "rule", "version", "k", F.get("gaps", F.col("k")).cast("long").alias("gap"), "m.length", "m.valid")
    before = Window.partitionBy("blob", "rule").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("gap") + F.col("length")).over(before), F.lit(0)) + F.col("gap")
    return each.withColumn("start", start).where("valid").select(
        "blob", "rule", "version", "start", (F.col("start") + F.col("length")).alias("end"))


class Ledger:
    """The tables ``scans`` and ``findings`` below ``path`` (a fresh folder of
    the shared store, if none is given). One run at a time may write."""

    def __init__(self, spark: SparkSession, path: str | None = None, rules: tuple[Rule, ...] = RULES):
        if len({r.name for r in rules}) < len(rules):
            raise ValueError("two rules have one name")
        self.spark, self.rules = spark, rules
        self.path = path or shared_path(spark, "ledger")

    def _table(self, name: str, schema: str) -> DataFrame:
        path = f"{self.path}/{name}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(path)
        return rows.where(reduce(or_, [(F.col("rule") == r.name) & (F.col("version") == r.version) for r in self.rules]))

    def scans(self) -> DataFrame:
        """``blob, rule, version`` scanned so far, for the ledger's own rules."""
        return self._table("scans", "blob string, rule string, version int")

    def findings(self) -> DataFrame:
        """``blob, rule, version, start, end``. A run that fails after its
        findings and before its scans leaves rows that the next one repeats."""
        return self._table("findings", "blob string, rule string, version int, start long, end long").distinct()

    def ingest(self, versions: DataFrame, text: str = "text", blob: str = "blob") -> DataFrame:
        """Scan what the ledger has not seen; returns the rows of ``versions``
        without ``text``, with ``blob`` (a column of that name is replaced).

        Null texts count as empty. Repeated rows stay, and share a blob. An
        empty table changes nothing. Whole texts are scanned, one of each blob:
        ``dropDuplicates`` keeps one a task before its shuffle, so a text that a
        third of all rows share costs one row a task.
        """
        body = F.coalesce(F.col(text), F.lit(""))
        address = F.sha2(body, 256)
        paths = written(versions.select(*[c for c in versions.columns if c.lower() not in (text.lower(), blob.lower())],
                                        address.alias(blob)), "blob-paths")
        texts = versions.select(address.alias("blob"), body.alias("text")).dropDuplicates(["blob"])
        every = F.array(*[F.lit(r.name) for r in self.rules])
        if path_exists(self.spark, f"{self.path}/scans"):
            done = self.scans().groupBy("blob").agg(F.collect_set("rule").alias("done"))
            missing = F.array_except(every, F.coalesce("done", F.array().cast("array<string>")))
            todo = texts.join(done, "blob", "left").select("blob", "text", missing.alias("rules")).where(F.size("rules") > 0)
        else:
            todo = texts.withColumn("rules", every)
        # Findings first: a scan that is in the ledger has all its findings there.
        marks = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"),
                                   F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("end"))
                          for r in self.rules])
        scanned = todo.select("blob", "rules", F.inline(marks)).where(F.array_contains(F.col("rules"), F.col("rule"))).drop("rules")
        both = written(spans(todo, self.rules).unionByName(scanned), "scan")
        both.where("start IS NOT NULL").write.mode("append").parquet(f"{self.path}/findings")
        both.where("start IS NULL").select("blob", "rule", "version").write.mode("append").parquet(f"{self.path}/scans")
        delete_path(self.spark, both._scratch.path)
        return paths

    def by_path(self, paths: DataFrame, blob: str = "blob") -> DataFrame:
        """Every row of ``paths`` with ``spans``: its secrets as an array of
        ``(start, place, end, rule)`` by start and place, the rule's number in
        the ledger's order. A blob that a third of all rows share is joined in
        pieces. A column ``spans`` of ``paths`` is replaced."""
        place = F.array_position(F.array(*[F.lit(r.name) for r in self.rules]), F.col("rule")).cast("int")
        (key,) = fresh(paths, "blob")
        per_blob = written(self.findings().groupBy("blob").agg(F.array_sort(F.collect_list(
            F.struct("start", place.alias("place"), "end", "rule"))).alias("spans")).withColumnRenamed("blob", key), "blob-spans")
        kept = paths.select(*[c for c in paths.columns if c.lower() != "spans"])
        found = join_unique(kept.withColumn(key, F.col(blob)), per_blob, key, "left")
        return borrowed(found.select(*kept.columns, F.coalesce("spans", F.array().cast(
            per_blob.schema["spans"].dataType)).alias("spans")), per_blob)

    def forget(self) -> None:
        """Delete the ledger."""
        delete_path(self.spark, self.path)


def written_out(found: Column) -> Column:
    """``kind:start:end`` of an array of spans, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["rule"], s["start"], s["end"])), ",")
