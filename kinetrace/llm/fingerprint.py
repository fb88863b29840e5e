"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph (a line that is not blank) hashes to a wide vector of 32-bit lanes,
and a document's fingerprint is the sum of its paragraphs' vectors modulo
2**32. So order does not matter, and a paragraph is inserted or deleted by one
addition or subtraction. The first lanes are uniform and decide equality; the
others hold, for each pair of neighbouring words of the paragraph, one or minus
one, so that the inner product of two documents' lanes estimates what they
share, and likeness can be read from two fingerprints alone.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kinetrace.llm.textcore import bounded, byte_table, hashed_words, mix, salt, shingles, slices, trimmed, utf8

#: 32-bit lanes for equality and for likeness (a multiple of 64); words in a run that the latter count.
EQUAL, ALIKE, RUN = 32, 128, 2
_WORD = byte_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
_BLOCK = 1 << 20


def _signs(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the likeness lanes for each row."""
    n = len(offsets) - 1
    breaks = np.unique(np.concatenate([offsets, np.flatnonzero(data == 0x0A) + 1]))
    _, _, counts, codes = hashed_words(data, breaks, _WORD)
    hashed, paragraph = shingles(codes, counts, RUN)
    out = np.zeros((n, ALIKE), np.int64)
    if not len(hashed):
        return out.astype(np.uint32)
    row = np.searchsorted(offsets, breaks[paragraph], "right") - 1
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    step = np.arange(0, len(row), 255)  # sums of up to 255 bits fit a byte
    cuts = np.union1d(first, step)
    bits = np.empty((len(hashed), ALIKE // 64), np.uint64)
    for w in range(ALIKE // 64):
        bits[:, w] = mix(hashed + salt(w + 1))
    ones = np.add.reduceat(np.unpackbits(bits.view(np.uint8), axis=1), cuts, axis=0, dtype=np.uint8).astype(np.int64)
    sizes = np.diff(np.append(cuts, len(row)))
    np.add.at(out, row[cuts], 2 * ones - sizes[:, None])
    return (out & 0xFFFFFFFF).astype(np.uint32)


def vectors(column: pa.Array) -> np.ndarray:
    """Fingerprints of texts as lanes; null counts as empty, and empty texts have all lanes 0."""
    n = len(column)
    data, offsets = utf8(column)
    out = np.zeros((n, EQUAL + ALIKE), np.uint32)
    for i, j in slices(offsets, _BLOCK):
        part = data[offsets[i] : offsets[j]]
        out[i:j, EQUAL:] = _signs(part, offsets[i : j + 1] - offsets[i])
    raw = data.tobytes()
    digests, owners = [], []
    for r in range(n):
        for line in raw[offsets[r] : offsets[r + 1]].split(b"\n"):
            if line and not line.isspace():
                digests.append(hashlib.shake_128(line).digest(4 * EQUAL))
                owners.append(r)
        if r + 1 == n or len(digests) > 20_000:
            lanes = np.frombuffer(b"".join(digests), "<u4").reshape(-1, EQUAL)
            np.add.at(out[:, :EQUAL], np.array(owners, np.int64), lanes)
            digests, owners = [], []
    return out


def insert(vector: np.ndarray, paragraphs: Iterable[str]) -> np.ndarray:
    """The fingerprint after paragraphs (without line ends) have come in."""
    return vector + vectors(pa.array(list(paragraphs), pa.string())).sum(axis=0, dtype=np.uint32)


def delete(vector: np.ndarray, paragraphs: Iterable[str]) -> np.ndarray:
    """The fingerprint after paragraphs have gone."""
    return vector - vectors(pa.array(list(paragraphs), pa.string())).sum(axis=0, dtype=np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of word pairs that two rows of fingerprints have in common, estimated: 1 for equal ones, else 0 to 1."""
    x, y = a[:, EQUAL:].astype(np.int32).astype(float), b[:, EQUAL:].astype(np.int32).astype(float)
    total = (x * x).sum(axis=1) + (y * y).sum(axis=1)
    alike = np.clip(2 * (x * y).sum(axis=1) / np.maximum(total, 1), 0, 1)
    return np.where((a == b).all(axis=1), 1.0, alike)


def as_text(rows: np.ndarray) -> list[str]:
    return [base64.b64encode(r.astype("<u4").tobytes()).decode() for r in rows]


def from_text(value: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(value), "<u4")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``fingerprint`` (base64) of each row, in a narrow pass."""
    bounded(df.sparkSession)
    narrow = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(as_text(vectors(b.column(1))), pa.string())], ["id", "fingerprint"])

    return narrow.mapInArrow(trimmed(run), f"id {narrow.schema['id'].dataType.simpleString()}, fingerprint string").toDF(id_col, "fingerprint")


def _runs_before(bounds: list, id_: Column) -> Column:
    """How many of the sorted bounds are below the id; found in two steps, so that a row is compared with few of them."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    below = lambda c: F.size(F.filter(c, lambda b: b < id_))
    blocks = F.array(*[F.lit(bounds[min(k + step, len(bounds)) - 1]) for k in range(0, len(bounds), step)])  # the last of each block
    done = F.least(below(blocks) * step, F.lit(len(bounds)))
    return F.coalesce(F.when(done < len(bounds), done + below(F.slice(F.array(*[F.lit(b) for b in bounds]), done + 1, F.lit(step)))).otherwise(done), F.lit(0))


def in_order(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """Rows dealt into runs of descending ids, each with a copy of the row that follows the run.

    Bounds of the runs come from ids that a hash picks, about 64 for each run,
    which is a number that the session's partitions set. The head of each run
    also goes to the run before it, and the first head to the last run. Texts
    are shuffled once.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    runs = 4 * parts  # several to a partition, which evens them out
    known = rows.where("id is not null").select("id")
    share = min(1.0, 64 * runs / max(1, known.count()))
    picked = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).distinct().orderBy("id").collect()
    ids = [r.id for r in picked]
    bounds = sorted({ids[k * len(ids) // runs] for k in range(1, runs)}) if ids else []
    placed = rows.withColumn("run", _runs_before(bounds, F.col("id")))
    heads = sorted((r.run, r.head) for r in placed.groupBy("run").agg(F.max("id").alias("head")).collect())
    follow = [(heads[k][1], heads[(k + 1) % len(heads)][0]) for k in range(len(heads))]
    guests = F.broadcast(spark.createDataFrame(follow, f"head {rows.schema['id'].dataType.simpleString()}, guest_of int"))  # a row for each run
    visits = placed.join(guests, F.col("id").eqNullSafe(F.col("head"))).select("id", "t", F.col("guest_of").alias("run"), F.lit(True).alias("guest"))
    both = placed.select("id", "t", "run", F.lit(False).alias("guest")).unionByName(visits)
    dealt = both.repartition(parts, "run").sortWithinPartitions("run", "guest", F.desc_nulls_last("id"), F.desc_nulls_last("t"))
    return dealt.select("run", "guest", "id", "t"), parts


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of an edited one, and their likeness.

    The edited text has the last third (floor) of its code points replaced by
    as many first ones (or all) of the document with the next smaller id; after
    the smallest comes the largest. Ids are of any type that has an order and is
    kept by Arrow as it is; null ids come last, rows with equal ids by
    descending text. Null texts count as empty. Returns
    ``id_col``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.
    """
    bounded(df.sparkSession)
    dealt, _ = in_order(df, id_col, text_col)
    id_type = dealt.schema["id"].dataType
    kind = to_arrow_type(id_type)
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def made(ids: list, texts: list[str]) -> pa.RecordBatch:
        """Rows for all but the last text, which only follows."""
        own = texts[:-1]
        edited = [t[: len(t) - len(t) // 3] + after[: len(t) // 3] for t, after in zip(own, texts[1:], strict=True)]
        a, b = vectors(pa.array(texts, pa.large_string())), vectors(pa.array(edited, pa.large_string()))
        columns = [
            pa.array(ids, kind),
            pa.array([len(t) for t in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array(as_text(a[:-1]), pa.string()),
            pa.array(as_text(b), pa.string()),
            pa.array(likeness(a[:-1], b)),
            pa.array(likeness(a[:-1], a[1:])),
        ]
        return pa.RecordBatch.from_arrays(columns, ["id", *names[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        size, current, ended = 0, None, False
        for batch in batches:
            for r, guest, i, t in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if r != current:
                    ids, texts, size, current, ended = [], [], 0, r, False
                if ended:
                    continue  # further rows with the id of the one that follows
                t = t or ""
                texts.append(t)
                if guest:
                    ended = True
                    if ids:
                        yield made(ids, texts)
                    continue
                size += len(t)
                if ids and size > _BLOCK:
                    yield made(ids, texts)
                    ids, texts, size = [], [t], len(t)
                ids.append(i)

    schema = f"id {id_type.simpleString()}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInArrow(trimmed(run), schema).toDF(*names)
