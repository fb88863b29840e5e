"""Vector compression by codes of equal parts: a product quantiser in whole numbers.

Vectors become integers, floor(256 * x), and are cut into equal parts. Each part
position has its codebook. Training keeps the vectors as blocks of NumPy columns
(one column a dimension) in an RDD: a task adds up distances dimension by
dimension, adds its parts into int64 tensors of sums and counts with
``np.add.at``, and ``treeAggregate`` merges the tensors through a reduction tree,
so that the driver gets a few of them whatever the number of tasks. All sums are
of whole numbers; neither blocks nor their order change a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetrace.llm.textcore import bounded, trimmed
from kinetrace.sources.stage import shared_folder, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Bytes of components in a block, and vectors whose distances to all entries are held at once.
BLOCK_BYTES, HELD = 4 << 20, 1 << 13
#: A label with more than this share of all rows counts as hot; there are fewer than its inverse.
HOT_SHARE = 256


def kept_vectors(df: DataFrame, vec_col: str = "embedding") -> Column:
    """Whether the vector is there and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.col(vec_col).isNotNull() & F.coalesce(F.forall(F.col(vec_col).cast("array<double>"), finite), F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """(dimensions, rows) of a list column of doubles, as whole numbers; raises on other lengths or numbers out of range."""
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes != width).any():
        raise ValueError(f"vectors have {width} components, but one has {int(sizes[sizes != width][0])}")
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE)
    # Squared distances of whole vectors stay below 2**62.
    limit = int((2**60 / max(width, 1)) ** 0.5)
    if len(values) and np.abs(values).max() >= limit:
        raise ValueError(f"a component's whole number is not below {limit}, so squared distances may not fit into 64 bits")
    return np.ascontiguousarray(values.astype(np.int64).reshape(len(sizes), width).T)


def assign(block: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part (parts, rows) and the squared distances; ties go to the lower index.

    ``block`` is (dimensions, rows), ``books`` (parts, entries, width).
    """
    parts, _, width = books.shape
    rows = block.shape[1]
    codes, errors = np.zeros((parts, rows), np.int64), np.zeros((parts, rows), np.int64)
    for a in range(0, rows, HELD):
        own = block[:, a : a + HELD]
        for p in range(parts):
            distance = np.zeros((books.shape[1], own.shape[1]), np.int64)
            for d in range(width):
                step = own[p * width + d] - books[p, :, d : d + 1]
                distance += step * step
            nearest = distance.argmin(axis=0)
            codes[p, a : a + HELD] = nearest
            errors[p, a : a + HELD] = np.take_along_axis(distance, nearest[None], axis=0)[0]
    return codes, errors


def _blocks(vectors: DataFrame, width: int) -> DataFrame:
    """Blocks of columns: rows, and the (dimensions, rows) matrix as bytes."""
    most = max(1, BLOCK_BYTES // max(1, 8 * width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _matrix(batch.column(0), width)
            for a in range(0, whole.shape[1], most):
                part = np.ascontiguousarray(whole[:, a : a + most])
                yield pa.RecordBatch.from_arrays([pa.array([part.shape[1]], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["n", "data"])

    return vectors.mapInArrow(trimmed(run), "n int, data binary")


def improved(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round: each used entry becomes its parts' floored mean."""
    parts, entries, width = books.shape

    def add(total: tuple[np.ndarray, np.ndarray] | None, row) -> tuple[np.ndarray, np.ndarray]:
        sums, counts = total or (np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64))
        block = np.frombuffer(row["data"], np.int64).reshape(parts * width, row["n"])
        codes, _ = assign(block, books)
        for p in range(parts):
            np.add.at(sums[p], codes[p], block[p * width : (p + 1) * width].T)
            np.add.at(counts[p], codes[p], 1)
        return sums, counts

    def merge(a, b):
        return b if a is None else a if b is None else (a[0] + b[0], a[1] + b[1])

    data = blocks.rdd
    depth = 2 + (data.getNumPartitions() > 1024)
    total = data.treeAggregate(None, add, merge, depth)
    if total is None:
        return books
    sums, counts = total
    return np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)


def fit(df: DataFrame, folder: str, id_col: str = "vec_id", vec_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (parts, entries, width) of the kept vectors; None where there are none.

    They begin as the vectors of the smallest ids: null ids come last, vectors
    of equal ids in order of their numbers, and fewer vectors than entries make
    fewer entries. Blocks are written below ``folder`` and read in each round.
    """
    bounded(df.sparkSession)
    vectors = df.where(kept_vectors(df, vec_col)).select(F.col(id_col).alias("i"), F.col(vec_col).cast("array<double>").alias("v"))
    whole = F.transform("v", lambda x: F.floor(x * SCALE).cast("double"))  # by the numbers' order, not that of -0.0
    first = vectors.select("i", whole.alias("v")).orderBy(F.col("i").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return None
    width = len(first[0]["v"])
    if any(len(r["v"]) != width for r in first) or width % parts:
        raise ValueError(f"vectors need one length that {parts} divides, not {sorted({len(r['v']) for r in first})}")
    books = np.array([r["v"] for r in first]).astype(np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2).copy()
    blocks = stored(_blocks(vectors.select("v"), width), folder, "blocks")
    for _ in range(rounds):
        books = improved(blocks, books)
    return books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimals joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encode(df: DataFrame, books: np.ndarray, id_col: str = "vec_id", vec_col: str = "embedding", keep: tuple[str, ...] = ()) -> DataFrame:
    """Id, kept columns, code (two hex digits a part) and error of every kept vector."""
    bounded(df.sparkSession)
    narrow = df.where(kept_vectors(df, vec_col)).select(F.col(id_col).alias("c0"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(keep, 1)], F.col(vec_col).cast("array<double>").alias("v"))
    kinds = [narrow.schema[f"c{k}"].dataType.simpleString() for k in range(len(keep) + 1)]
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = assign(_matrix(batch.column(batch.num_columns - 1), parts * width), books)
            digits = np.ascontiguousarray(codes.T.astype(np.uint8)).tobytes().hex()
            step = 2 * parts
            texts = [digits[k : k + step] for k in range(0, len(digits), step)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(errors.sum(axis=0))], [*batch.schema.names[:-1], "code", "error"])

    schema = ", ".join([f"c{k} {kind}" for k, kind in enumerate(kinds)] + ["code string, error bigint"])
    return narrow.mapInArrow(trimmed(run), schema).toDF(id_col, *keep, "code", "error")


def decode(codes: DataFrame, books: np.ndarray, code_col: str = "code", into: str = "vector") -> DataFrame:
    """The vectors that codes stand for, as doubles."""
    parts, _, width = books.shape
    table = F.array(*[F.array(*[F.array(*[F.lit(float(x) / SCALE) for x in entry]) for entry in part]) for part in books.tolist()])
    at = lambda p: F.conv(F.substring(code_col, 2 * p + 1, 2), 16, 10).cast("int")
    return codes.withColumn("_books", table).withColumn(into, F.concat(*[F.get(F.get("_books", F.lit(p)), at(p)) for p in range(parts)])).drop("_books")


def _label_totals(found: DataFrame) -> DataFrame:
    """Adds ``label_error``, the errors summed over equal labels.

    Hot labels, fewer than 256 whatever the input, are broadcast; the rest, of
    which none has more than a 256th of all rows, is joined by a shuffle.
    """
    spark = found.sparkSession
    totals = stored(found.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), shared_folder(spark), "totals")
    size = totals.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    hot = totals.where(F.col("n") * HOT_SHARE > size)
    met = found.join(F.broadcast(hot.select(F.col("label").alias("_l"), "label_error")), F.col("label").eqNullSafe(F.col("_l")), "left").drop("_l")
    cold = totals.where(F.col("n") * HOT_SHARE <= size).select(F.col("label").alias("_l"), F.col("label_error").alias("_e"))
    if cold.isEmpty():
        return met
    # Null is one label: where it is hot, its rows have met already.
    key = F.col("label").eqNullSafe(F.col("_l"))
    rest = met.where("label_error is null").drop("label_error").join(cold, key).drop("_l").withColumnRenamed("_e", "label_error")
    return met.where("label_error is not null").unionByName(rest)


def compress(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Codes of all vectors: id, code, error, label_error and codebooks_sha256.

    Rows whose vector is null or holds a null or non-finite component are
    dropped. Null ids and repeated rows are rows like others; null labels are
    one label; an empty table, or one without kept vectors, gives no rows. Only
    the named columns are read. Vectors of differing lengths, of a length that
    ``parts`` does not divide, or with components whose squared distances would
    not fit into 64 bits raise a ValueError.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    plain = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label"))
    books = fit(plain, folder, "id", "vec", parts, entries, rounds)
    if books is None:
        none = plain.where("false").select(F.col("id"), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
        return none.withColumnRenamed("id", id_col)
    found = stored(encode(plain, books, "id", "vec", ("label",)), folder, "codes")
    out = _label_totals(found).withColumn("codebooks_sha256", F.lit(books_digest(books)))
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error", "codebooks_sha256")


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB SQL of the query: every part against every entry, in each round."""
    near = lambda book: (
        f"SELECT r, part, (m).e AS e, (m).d AS d FROM (SELECT p.r, p.part, min({{'d': CAST(list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i]))) AS BIGINT), 'e': c.e}}) AS m FROM p JOIN {book} c ON c.part = p.part GROUP BY p.r, p.part)"
    )
    steps = []
    for k in range(rounds):
        steps.append(f"a{k} AS MATERIALIZED ({near(f'c{k}')})")
        steps.append(f"s{k} AS (SELECT a.part, a.e, i, sum(p.x[i]) AS s, count(*) AS n FROM a{k} a JOIN p ON p.r = a.r AND p.part = a.part, LATERAL (SELECT unnest(range(1, len(p.x) + 1)) AS i) GROUP BY a.part, a.e, i)")
        steps.append(f"m{k} AS (SELECT part, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM s{k} GROUP BY part, e)")
        steps.append(f"c{k + 1} AS MATERIALIZED (SELECT c.part, c.e, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN m{k} m ON m.part = c.part AND m.e = c.e)")
    return f"""
WITH k AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS x FROM k, (SELECT unnest(range({parts})) AS part)),
c0 AS (SELECT part, r - 1 AS e, x FROM p WHERE r <= {entries}),
{", ".join(steps)},
f AS MATERIALIZED ({near(f"c{rounds}")}),
t AS (SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM f GROUP BY r),
b AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM k JOIN t USING (r), b
"""
