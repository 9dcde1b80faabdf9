"""Secret scans over an incremental blob ledger, with DataFrame functions only.

Every version of every text is addressed by its content. The ledger holds the pairs of blob and rule version that
have been scanned; a scan looks at no other blobs, once each however many paths hold them, and joins what it and
earlier scans found back to all paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.session import fresh_path

RULE_VERSION = "2"
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
BLOBS = f"blob_id string, rule_version string, found {SPANS}"


@dataclass(frozen=True)
class Rule:
    """A pattern, the group whose length counts (0: the whole match) and its least length."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The patterns and least lengths of the base kinds, in their order.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
# Further kinds of this rule version: a private key's frame, and a signed web token of three parts.
EXTRA = (
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def _narrowed(rule: Rule) -> str:
    """A pattern that finds the same long enough matches without the short ones, where that is possible.

    A single run of one class is as long as it can be wherever it begins, so a short one can hide no longer one.
    """
    return rule.pattern[:-1] + f"{{{rule.least - (4 if rule.kind == 'access' else 0)},}}" if rule.kind in ("access", "hex") else rule.pattern


def spans(text: Column, rule: Rule) -> Column:
    """Spans (kind, start, end) of a rule's matches, in code points, leftmost first and without overlaps.

    The text between matches and the matches themselves are read off by the same pattern; running sums of their
    lengths give the places.
    """
    pattern = F.lit(_narrowed(rule))
    between, found = F.split(text, _narrowed(rule), -1), F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    parts = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("gap"), found.alias("whole"), value.alias("value"))
    sizes = F.transform(parts, lambda p: F.struct(F.length(p["gap"]).alias("gap"), F.length(p["whole"]).alias("whole"), F.length(p["value"]).alias("value")))
    none = F.array().cast(SPANS)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out"))

    def step(acc, p):
        begin = acc["at"] + p["gap"]
        end = begin + p["whole"]
        span = F.struct(F.lit(rule.kind).alias("kind"), begin.cast("bigint").alias("start"), end.cast("bigint").alias("end"))
        return F.struct(end.cast("bigint").alias("at"), F.when(p["value"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.when(text.rlike(_narrowed(rule)), F.aggregate(sizes, start, step)["out"]).otherwise(none)


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = BASE + EXTRA) -> DataFrame:
    """``blob_id``, ``found`` (all spans, by rule, then start) of blobs (blob_id, text)."""
    return blobs.select("blob_id", F.concat(*[spans(F.col("text"), r) for r in rules]).alias("found"))


def address(docs: DataFrame) -> DataFrame:
    """``docs`` with ``blob_id``, the digest of the text; a null text is an empty one."""
    return docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("blob_id", F.sha2(F.col("text"), 256))


def _has_rows(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def update_ledger(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = BASE + EXTRA, version: str = RULE_VERSION) -> DataFrame:
    """Scan the blobs of ``docs`` (doc_id, text) that the ledger does not have for this rule version, add them, and
    return the ledger's rows of this version.

    A doc_id may have several versions, each a row with a text of its own, and rows may repeat. Each unseen blob is read
    at one of its paths, the one with the smallest doc_id (null only if it has no other). A failed run adds nothing, or
    rows that the next run finds there.
    """
    spark = docs.sparkSession
    paths = address(docs.select("doc_id", "text"))
    firsts = paths.groupBy("blob_id").agg(F.min("doc_id").alias("doc_id"))
    if _has_rows(spark, ledger):
        seen = spark.read.schema(BLOBS).parquet(ledger).filter(F.col("rule_version") == version).select("blob_id")
        firsts = firsts.join(seen, "blob_id", "left_anti")
    # By path and content: another version of the same path is another blob.
    firsts = firsts.select(F.col("blob_id").alias("_blob"), F.col("doc_id").alias("_path"))
    unseen = paths.join(firsts, (F.col("blob_id") == F.col("_blob")) & F.col("doc_id").eqNullSafe(F.col("_path"))).select("blob_id", "text")
    found = scan(unseen, rules).select("blob_id", F.lit(version).alias("rule_version"), "found").dropDuplicates(["blob_id"])
    found.write.mode("append").parquet(ledger)
    return spark.read.schema(BLOBS).parquet(ledger).filter(F.col("rule_version") == version)


def find_secrets(docs: DataFrame, ledger: str) -> DataFrame:
    """``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans`` of every row of ``docs``.

    Whole texts are scanned; null and empty texts have no spans. Each version of a doc_id has a row with its own spans;
    so have repeated rows and rows without a doc_id. Other columns are ignored; an empty table gives no rows.
    """
    stored = update_ledger(docs, ledger).filter(F.size("found") > 0).select("blob_id", "found").distinct()
    order = {r.kind: k for k, r in enumerate(BASE + EXTRA)}
    rank = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    keyed = F.transform("found", lambda x: F.struct(x["start"].alias("start"), rank[x["kind"]].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")))
    stored = stored.select("blob_id", F.array_sort(keyed).alias("found"))
    base = F.filter("found", lambda x: x["rank"] < len(BASE))
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    counts = [count(rule.kind) for rule in BASE]
    findings = stored.select("blob_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("found")).alias("spans"))
    paths = address(docs.select("doc_id", "text")).select("doc_id", "blob_id")
    joined = paths.join(findings, "blob_id", "left")
    zeros = {f"n_{k}": 0 for k in ("assign", "access", "hex")}
    return joined.na.fill(zeros).na.fill({"base_sha256": NO_SPANS, "spans": ""}).select("doc_id", *zeros, "base_sha256", "spans")


# The digest of an empty text.
NO_SPANS = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of all documents, with a ledger that begins empty."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_secrets(docs, fresh_path(spark, "secret-ledger"))


QUERIES = {"op10_secrets": op10_secrets}


def _matches_sql(rule: Rule, rank: int) -> str:
    pattern = _narrowed(rule).replace("'", "''")
    return f"""
    select doc_id, '{rule.kind}' as kind, {rank} as rank, string_split_regex(t, '{pattern}') as gaps,
        regexp_extract_all(t, '{pattern}', 0) as wholes, regexp_extract_all(t, '{pattern}', {rule.group}) as vals, {rule.least} as least
    from texts where regexp_matches(t, '{pattern}')"""


SQL = {
    "op10_secrets": f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
matches as ({" union all ".join(_matches_sql(r, k) for k, r in enumerate(BASE + EXTRA))}),
numbered as (select *, unnest(range(1, len(wholes) + 1)) as k from matches),
placed as (
    select doc_id, kind, rank, list_sum(list_transform(gaps[1:k], lambda x: length(x)))
        + coalesce(list_sum(list_transform(wholes[1:k - 1], lambda x: length(x))), 0) as start, length(wholes[k]) as size
    from numbered where length(vals[k]) >= least
),
spans as (select doc_id, kind, rank, start, kind || ':' || cast(start as bigint) || ':' || cast(start + size as bigint) as span from placed)
select d.doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
    sha256(coalesce(string_agg(span, ',' order by start, rank) filter (rank < {len(BASE)}), '')) as base_sha256,
    coalesce(string_agg(span, ',' order by start, rank), '') as spans
from documents d left join spans s on s.doc_id = d.doc_id group by d.doc_id
"""
}
