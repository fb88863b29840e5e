"""Secret scanning over an incremental ledger of blobs, in DataFrame operations only.

Every historical version of a text is a blob named by the SHA-256 of its
content. A ledger says which rules, at which version, have scanned which blob.
A scan takes the pairs of blob and rule version that the ledger lacks, reads
each such blob once, appends what it found and the pairs to the ledger, and
joins the findings of all blobs back to every path and version that holds them.
Hashes alone decide what is to be read: texts that occur once and are new are
scanned where they lie, and only those that repeat, or that some rules have
seen, are shuffled.

A rule's matches come from its pattern's pieces: the text between matches and
the matches themselves, whose lengths summed up give offsets in code points.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinetrace.llm.sieve import bit_table, split
from kinetrace.sources.stage import shared_folder, stored


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``least`` characters or more.

    Matches are leftmost and do not overlap; those that fail are dropped and
    their characters stay consumed. A change needs a new ``version``.
    """

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base rules' patterns and lengths. A run of hex digits or of an access key's characters
#: is matched whole, so its least length can stand in the pattern.
ASSIGN = Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6)
ACCESS = Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20)
HEX = Rule("hex", r"[0-9a-f]{24,}", 0, 24)
#: Rules that this method adds.
PEM = Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1)
JWT = Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 1)
BASE, RULES = (ASSIGN, ACCESS, HEX), (ASSIGN, ACCESS, HEX, PEM, JWT)


def _pieces(rule: Rule, order: int, text: Column, wanted: Column) -> Column:
    """Array of (rule, place, gap before, length of match or null at the end, length of the group)."""
    parts = F.arrays_zip(F.regexp_extract_all(text, F.lit(rule.pattern), 0).alias("m"), F.split(text, rule.pattern, -1).alias("s"))
    # A match, matched again by itself, has the same groups: no pattern looks around.
    value = lambda m: F.length(F.regexp_extract(m, rule.pattern, rule.group)) if rule.group else F.length(m)
    found = F.transform(parts, lambda x, i: F.struct(F.lit(order).alias("rule"), i.alias("place"), F.length(x["s"]).alias("gap"), F.length(x["m"]).alias("size"), value(x["m"]).alias("value")))
    return F.when(wanted & text.rlike(rule.pattern), found)


def scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings (blob_id, kind, rule, start, end) in blobs (blob_id, text, rules: names of the rules to run).

    Offsets count code points; the end is exclusive. ``rule`` is the rule's
    place in ``rules``.
    """
    arrays = [_pieces(r, k, F.col("text"), F.array_contains("rules", r.name)) for k, r in enumerate(rules)]
    none = F.array().cast("array<struct<rule:int,place:int,gap:int,size:int,value:int>>")
    rows = blobs.select("blob_id", F.explode(F.concat(*[F.coalesce(a, none) for a in arrays])).alias("p")).select("blob_id", "p.*")
    before = Window.partitionBy("blob_id", "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("gap") + F.coalesce(F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(before), F.lit(0))
    least = F.array(*[F.lit(r.least) for r in rules])
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    spans = rows.withColumn("start", start).where(F.col("size").isNotNull() & (F.col("value") >= F.get(least, F.col("rule"))))
    return spans.select("blob_id", F.get(kinds, F.col("rule")).alias("kind"), "rule", F.col("start").cast("long").alias("start"), (F.col("start") + F.col("size")).cast("long").alias("end"))


SEEN, FOUND = "blob_id binary, rule string", "blob_id binary, kind string, rule string, start bigint, end bigint"


def _batches(spark: SparkSession, ledger: str) -> list[str]:
    """Names of the ledger's finished batches: those whose list of pairs was written to its end."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ledger}/seen")
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(at):
        return []
    done = system.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ledger}/seen/batch=*/_SUCCESS"))
    return sorted(f.getPath().getParent().getName() for f in done)


def _read(spark: SparkSession, ledger: str, name: str, schema: str) -> DataFrame:
    """A ledger table, empty where nothing was written yet."""
    paths = [f"{ledger}/{name}/{b}" for b in _batches(spark, ledger)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def compact(spark: SparkSession, ledger: str, into: str) -> None:
    """Writes the ledger's batches as one batch of the new ledger ``into``."""
    batch = f"batch={uuid.uuid4().hex}"
    _read(spark, ledger, "found", FOUND).distinct().write.parquet(f"{into}/found/{batch}")
    _read(spark, ledger, "seen", SEEN).distinct().write.parquet(f"{into}/seen/{batch}")


def _named(versions: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return versions.select(F.unhex(F.sha2(text.cast("binary"), 256)).alias("blob_id"), text.alias("text"))


def update(versions: DataFrame, ledger: str, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scans what the ledger at the folder ``ledger`` lacks, and returns the findings of these versions' blobs under ``rules``.

    Returns (blob_id, spans: array of (start, rule, kind, end) in order); blobs
    without a finding are left out. A batch counts once its list of pairs is
    whole, so a scan that broke off is simply repeated.
    """
    spark = versions.sparkSession
    folder = shared_folder(spark)
    named = _named(versions, text_col)
    names = F.array(*[F.lit(r.name) for r in rules])
    none = F.array().cast("array<string>")
    own = stored(named.groupBy("blob_id").agg(F.count(F.lit(1)).alias("copies")), folder, "blobs")
    # Of a long history only rows that may be of these blobs are shuffled.
    past, _ = split(_read(spark, ledger, "seen", SEEN), stored(bit_table(own, "blob_id"), folder, "own_bits"), F.col("blob_id"))
    known = past.join(own, "blob_id", "left_semi").groupBy("blob_id").agg(F.collect_set("rule").alias("known"))
    todo = own.join(known, "blob_id", "left").withColumn("rules", F.array_except(names, F.coalesce("known", none)))
    todo = stored(todo.where(F.size("rules") > 0).select("blob_id", "copies", "rules"), folder, "todo")
    special = todo.where((F.col("copies") > 1) | (F.size("rules") < len(rules)))
    fresh = todo.count() == own.count()
    wanted = named if fresh else split(named, stored(bit_table(todo, "blob_id"), folder, "todo_bits"), F.col("blob_id"))[0]
    # Blobs that need a look at the list: repeated, seen by some rules, or (where some blobs are known) not wanted at all.
    apart = special if fresh else special.select("blob_id").union(own.join(todo, "blob_id", "left_anti").select("blob_id"))
    maybe, plain = split(wanted, stored(bit_table(apart, "blob_id"), folder, "apart_bits"), F.col("blob_id"))
    listed = maybe.join(todo, "blob_id")
    once = listed.where("copies = 1").select("blob_id", "text", "rules")
    repeated = listed.where("copies > 1").groupBy("blob_id").agg(F.first("text").alias("text"), F.first("rules").alias("rules"))  # combined before the shuffle, so copies do not travel
    blobs = plain.select("blob_id", "text", names.alias("rules")).unionByName(once).unionByName(repeated)
    batch = f"batch={uuid.uuid4().hex}"
    scan(blobs, rules).select("blob_id", "kind", F.get(names, F.col("rule")).alias("rule"), "start", "end").write.parquet(f"{ledger}/found/{batch}")
    todo.select("blob_id", F.explode("rules").alias("rule")).write.parquet(f"{ledger}/seen/{batch}")
    return findings(spark, ledger, rules, own)


def findings(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES, blobs: DataFrame | None = None) -> DataFrame:
    """All findings in the ledger under these rules, an array for each blob (of ``blobs``, if given) that has some."""
    order = F.array(*[F.lit(r.name) for r in rules])
    valid = _read(spark, ledger, "found", FOUND).where(F.array_contains(order, F.col("rule")))
    if blobs is not None:
        valid = valid.join(blobs, "blob_id", "left_semi")
    span = F.struct("start", (F.array_position(order, F.col("rule")) - 1).cast("int").alias("rule"), "kind", "end")
    return valid.groupBy("blob_id").agg(F.array_sort(F.collect_set(span)).alias("spans"))


def scan_history(versions: DataFrame, ledger: str, text_col: str = "text", rules: tuple[Rule, ...] = RULES, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Findings of every version row: the columns ``keep``, ``blob_id`` and ``spans`` (empty if nothing was found).

    A null text counts as empty. Rows are not merged: repeated rows, null ids
    and several versions of a path each get their blob's findings. Rows of one
    hot blob join a single small row, which adaptive execution can split.
    """
    found = update(versions, ledger, text_col, rules)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = versions.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.unhex(F.sha2(text.cast("binary"), 256)).alias("blob_id"))
    none = F.array().cast("array<struct<start:bigint,rule:int,kind:string,end:bigint>>")
    out = rows.join(found, "blob_id", "left").withColumn("spans", F.coalesce("spans", none))
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "blob_id", "spans")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans in order, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with its spans (sorted by start; they may overlap) replaced by a mark."""
    empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        more = F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))
        later = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), more.alias("out"))).otherwise(later)

    done = F.aggregate(spans, empty, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL for the query over ``documents``."""
    found = []
    for k, r in enumerate(rules):
        p = r.pattern.replace("'", "''")
        found.append(f"SELECT doc_id, {k} AS k, '{r.kind}' AS kind, {r.least} AS least, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {r.group}) AS g, regexp_split_to_array(t, '{p}') AS s FROM d")
    base = ", ".join(f"'{r.kind}'" for r in BASE)
    counts = ", ".join(f"CAST(count(*) FILTER (kind = '{r.kind}') AS BIGINT) AS n_{r.kind}" for r in BASE)
    text = "coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k){}, '')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS ({" UNION ALL ".join(found)}),
i AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM f),
p AS (SELECT doc_id, k, kind, CAST(coalesce(list_sum(list_transform(s[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a, length(m[i]) AS n FROM i WHERE length(g[i]) >= least),
q AS (SELECT doc_id, k, kind, a, a + n AS b FROM p),
r AS (SELECT doc_id, {counts}, sha256({text.format(f" FILTER (kind IN ({base}))")}) AS base_sha256, {text.format("")} AS spans FROM q GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)}, coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN r USING (doc_id)
"""
