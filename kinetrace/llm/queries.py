"""The queries ``opN_<name>`` over the training-data tables, and their SQL.

Each callable takes the session and a folder of Parquet tables and returns the
operator's whole result over the whole table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetrace.llm import decontam, fingerprint, langid, licenses, neardup, oracles, partcodes, pieces, preference, secrets, toxicity, urlfilter, warc
from kinetrace.sources.stage import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    """Place of a public vocabulary file, which is never copied into this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, hit words and leaked items of each document; a null text has no words, and a repeated row is judged like its twin."""
    found = decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL, null ones too, judged by rules and then by a model of the built-in labelled table."""
    weights, bias = urlfilter.train(urlfilter.labelled())
    return urlfilter.judge(table(spark, sf_dir, "pages"), weights, bias)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of each whole document as digests; null counts as empty and has no ids."""
    return pieces.encode_texts(table(spark, sf_dir, "documents"), tokenizer_path(), digests=True)


def crc_part(parts: int, id_col: str = "doc_id"):
    """Remainder of the CRC-32 of an id's text; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def fit_langid(docs: DataFrame) -> langid.ByteCNN | None:
    """The model of query 4: rows with remainder 2 are held out."""
    return langid.fit(docs, crc_part(4) != 2)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each whole document; ``und`` with score 0 where the text is null or has no letter. A null id is not held out."""
    docs = table(spark, sf_dir, "documents")
    out = langid.identify(docs, fit_langid(docs))
    return out.select("doc_id", F.coalesce(crc_part(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four words a shingle, as this query's contract says; the operator's default is five."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=4)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses are read with their payloads, revisits by their headers alone."""
    path = f"{shared_folder(spark)}/archive"
    warc.archive(table(spark, sf_dir, "pages"), path)
    full = warc.read(spark, path).where(F.col("record_type") == "response")
    bare = warc.read(spark, path, payload=False).where(F.col("record_type") == "revisit")
    responses = full.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "record_type", "refers_to")
    return responses.unionByName(bare.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One version of each document, in two increments over one ledger: about half of the ids, then all.

    The second scans what the first has not seen, and findings of both are
    joined to every document. Null texts and ids are rows like others.
    """
    docs, ledger = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/ledger"
    secrets.update(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0), ledger)
    found = secrets.scan_history(docs, ledger)
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secrets.BASE]))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, lambda x: x == F.lit(kind))).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")]  # noqa: B023
    return found.select("doc_id", *counts, F.sha2(secrets.joined(base).cast("binary"), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def op8_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pair for each conversation: its last assistant turn against that of the one beside it, after the same prompt."""
    return preference.formatted(preference.shared_prompts(table(spark, sf_dir, "conversations")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with remainder 0 are held out; a null id is in neither part."""
    docs = table(spark, sf_dir, "documents")
    field = toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_part(5) != 0)
    out = toxicity.tag_texts(docs, field)
    offsets = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))))
    return out.select("doc_id", F.coalesce(crc_part(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), offsets.alias("offending"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each document and its edited text; null counts as empty, and the last id is followed by the first."""
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of each whole document; a null text has no words, and null ids and repeated rows are judged like others."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    names = lambda matches: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))))
    base = F.filter("matches", lambda m: m["label"].isin([t.label for t in licenses.BASE]))
    starts = F.transform(base, lambda m: m["start"])
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), names(base).alias("base_labels"), names("matches").alias("labels"), "score")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes, errors and the codebooks' digest of all vectors that are whole; null labels are one label."""
    return partcodes.compress(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_url_filter": op2_url_filter,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_language_id": op4_language_id,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_warc": op6_warc,
    "op7_secret_scan": op7_secret_scan,
    "op8_preference_format": op8_preference_format,
    "op9_toxicity": op9_toxicity,
    "op10_fingerprints": op10_fingerprints,
    "op11_license_scan": op11_license_scan,
    "op12_vector_codes": op12_vector_codes,
}


@cache
def _oracles() -> dict[str, str]:
    return {
        "op1_decontamination": oracles.decontamination(),
        "op2_url_filter": urlfilter.oracle(*urlfilter.train(urlfilter.labelled())),
        "op5_near_duplicates": oracles.near_duplicates(),
        "op6_warc": oracles.WARC,
        "op7_secret_scan": secrets.oracle(),
        "op8_preference_format": preference.ORACLE,
        "op11_license_scan": licenses.oracle(),
        "op12_vector_codes": partcodes.oracle(),
    }


def __getattr__(name: str):
    """``ORACLES``, the queries' DuckDB SQL, is made when it is first asked for, since one query's holds trained weights."""
    if name == "ORACLES":
        return _oracles()
    raise AttributeError(name)
