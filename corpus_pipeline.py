"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``. Null texts have no
letters and go in the first stage, as empty ones do; null ids, repeated rows
and other columns than those of ``documents`` are said of each stage below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinetrace.llm import decontam, langid, neardup, pieces, queries, secrets
from kinetrace.llm.sieve import bit_table, split
from kinetrace.sources.stage import drop, exists, mark, release, shared_folder, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document whose best language gets less than this is rejected, as is one without letters.
LEAST_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or of no clear language go; an unknown language is filled in. Null ids and repeated rows stay."""
    named = langid.identify(docs, queries.fit_langid(docs), keep=COLUMNS[1:])
    kept = named.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def _row_key(docs: DataFrame) -> Column:
    """What tells documents apart: the id, or where an id has several texts, the id and the text's hash, sorted by id first. Ids may be numbers or texts."""
    text = F.xxhash64("text")
    several = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(text).alias("a"), F.max(text).alias("b")).where("a <> b")
    if several.isEmpty():
        return F.col("doc_id")
    if isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        name = F.lpad(F.hex(F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")  # negative ids first
    else:
        name = F.hex(F.col("doc_id").cast("string").cast("binary"))
    return F.concat(name, F.lit("-"), F.lpad(F.hex(text), 16, "0"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that with the smallest id.

    Rows that share an id but not the text are documents of their own; of rows
    that repeat id and text one stays. Rows with a null id stay.
    """
    folder = shared_folder(spark)
    keyed = docs.select(*COLUMNS, _row_key(docs).alias("key"))
    found = stored(neardup.near_duplicates(keyed, "key"), folder, "found")
    gone = found.where("not kept").select("key").distinct()
    repeated = found.where("key is not null and kept").groupBy("key").count().where("count > 1").select("key")
    # Most rows are neither; a bit table of bounded size lets these pass without a shuffle.
    maybe, clear = split(keyed, stored(bit_table(gone.union(repeated), "key"), folder, "bits"), F.col("key"))
    left = maybe.join(gone, "key", "left_anti")
    once = left.groupBy("key").agg(F.min_by(F.struct(*COLUMNS), F.coalesce("text", F.lit(""))).alias("r")).select("r.*")
    return clear.select(*COLUMNS).unionByName(once.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of benchmark windows are cut out; a document with no other word goes. Documents without words, null ids and repeated rows stay."""
    found = decontam.find_leaks(docs, queries.table(spark, sf_dir, "benchmark"), keep=("lang", "source", "n_chars"))
    kept = found.where((F.col("n_hit") == 0) | (F.col("n_hit") < F.col("n_words")))
    n_chars = F.when(F.col("n_hit") > 0, F.length("clean_text").cast("long")).otherwise(F.col("n_chars").cast("long"))
    return kept.select("doc_id", F.col("clean_text").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str, ledger: str | None = None) -> DataFrame:
    """Secrets are replaced by a mark; no document goes, and rows with null ids or repeated ones are cleaned like others.

    With a ``ledger``, a folder that outlives the run, only texts that it has
    not seen under the present rules are scanned; without one, all are.
    """
    folder = shared_folder(spark)
    found = stored(secrets.update(docs, ledger or f"{folder}/ledger"), folder, "found")
    named = docs.select(*COLUMNS).withColumn("blob_id", F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)))
    # Most texts hold no secret; a bit table of bounded size lets these pass without a shuffle.
    maybe, clear = split(named, stored(bit_table(found, "blob_id"), folder, "bits"), F.col("blob_id"))
    met = maybe.join(found, "blob_id", "left")
    new = F.when(F.size("spans") > 0, secrets.redacted(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    n_chars = F.when(F.size("spans") > 0, F.length(new).cast("long")).otherwise(F.col("n_chars").cast("long"))
    changed = met.select("doc_id", new.alias("text"), "lang", "source", n_chars.alias("n_chars"))
    return clear.select(*COLUMNS[:4], F.col("n_chars").cast("long").alias("n_chars")).unionByName(changed)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, one row for each; a null text has none."""
    return pieces.encode_texts(docs, queries.tokenizer_path()).select("doc_id", "n_tokens", "ids")


STAGES: list[tuple[str, Callable[..., DataFrame]]] = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("SentencePiece encoding", sentencepiece),
]

#: SQL can express neither the network nor the encoder; a brute-force version checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None, ledger: str | None = None) -> DataFrame:
    """Applies all stages to ``documents``, each written and read again.

    With a ``folder``, stages that an earlier run has written there are not run
    again, so a run that broke off goes on where it was; their input must be the
    same. Without one, a stage's input is dropped once its output is there.
    ``ledger``: see :func:`secret_scan`. What stages write for themselves is
    dropped after each.
    """
    docs, base, before = queries.table(spark, sf_dir, "documents"), folder or shared_folder(spark), None
    for k, (_, stage) in enumerate(STAGES):
        last, place = k == len(STAGES) - 1, f"{base}/stage{k}"
        if not last and exists(spark, f"{place}/_SUCCESS"):
            docs = spark.read.parquet(place)
            continue
        since = mark()
        more = {"ledger": ledger} if stage is secret_scan and ledger else {}
        docs = stage(spark, docs, sf_dir, **more)
        if not last:
            docs = stored(docs, base, f"stage{k}")
            release(spark, since)
            if before and not folder:
                drop(spark, before)
            before = place
    return docs
