"""Near-duplicate groups by SuperMinHash, banding, verification and union-find.

Each shingle of a document draws one random permutation of the registers, step
by step; its value in the register of step j lies in [j, j + 1), so registers
of a document correlate, the estimate varies less than with independent hash
functions, and a document is done as soon as all registers hold values below
the next step. Sixteen bits of each register are kept.

Documents with equal shingle sets (by a 256-bit digest of the sorted set) are
put together first. Bands of registers give buckets. Links are then found in
two passes, both on full sets:

1. Each document of a bucket is compared with the bucket's smallest one. This
   joins most copies. A comparison is a row that streams past its bucket's
   smallest document, so a bucket may have any size.
2. A bucket whose documents do not all hang together yet is open. The sets of
   an open bucket meet in a task (those of a larger one in tasks of two blocks
   of bounded size each), and what they have in common is counted for all pairs
   of the task at once; links go into a union-find. Of open buckets with the
   same documents one is looked at.

So no list of all pairs is made, no bucket is capped, and no link that would
join two groups is left out. At a likeness of 0.8, 32 bands of 4 registers miss
a pair with a probability of about 5e-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetrace.llm.graph import components
from kinetrace.llm.sieve import bit_table, split
from kinetrace.llm.textcore import bounded, byte_table, hashed_words, lower_ascii, mix, salt, shingles, slices, trimmed, utf8
from kinetrace.sources.stage import drop, shared_folder, stored

BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
#: Documents and shingles of a block (about); documents that share a copy of their bucket's smallest one; cells of a
#: table that tells which document has which shingle.
BLOCK, BLOCK_SHINGLES, SPAN, CELLS = 1024, 1 << 20, 32, 1 << 22
#: Word bytes: all but blanks (0x20, 0x09-0x0D).
WORD = byte_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, one row after another, and each row's number."""
    _, _, counts, codes = hashed_words(lower_ascii(data), offsets, WORD)
    hashed, rows = shingles(codes, counts, k)
    ends = np.searchsorted(rows, np.arange(len(counts)), "right")
    parts, sizes, begin = [], np.zeros(len(counts), np.int64), 0
    for r, end in enumerate(ends.tolist()):
        if end > begin:
            own = np.sort(hashed[begin:end])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            parts.append(own[keep])
            sizes[r] = len(parts[-1])
        begin = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), sizes


def super_minhash(sets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Registers, shape (rows, REGISTERS): step in the upper and random value in the lower 32 bits; all ones for empty rows."""
    m, n = REGISTERS, len(sizes)
    out = np.full(n * m, np.iinfo(np.int64).max, np.int64)
    row, element = np.repeat(np.arange(n), sizes), sets
    drawn: list[np.ndarray] = []
    places: np.ndarray | None = None  # each element's permutation, once few are left
    for j in range(m):
        if not len(element):
            break
        x = mix(element + salt(j + 1))
        value = (x & np.uint64(0xFFFFFFFF)).astype(np.int64) | j << 32
        k = (j + ((x >> np.uint64(32)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)).astype(np.int16)
        if places is None and j >= 4:
            places = np.tile(np.arange(m, dtype=np.int16), (len(element), 1))
            every = np.arange(len(element))
            for i, d in enumerate(drawn):
                a, b = places[every, i].copy(), places[every, d].copy()
                places[every, i], places[every, d] = b, a
        if places is None:
            register = k
            for i in range(j - 1, -1, -1):
                register = np.where(register == drawn[i], np.int16(i), register)
            drawn.append(k)
        else:
            every = np.arange(len(element))
            register = places[every, k]
            places[every, k] = places[every, j]
            places[every, j] = register
        np.minimum.at(out, row * m + register, value)
        live = (out.reshape(n, m).max(axis=1) >= (j + 1) << 32) & (sizes > 0)
        if not live.all():
            keep = live[row]
            row, element, drawn = row[keep], element[keep], [d[keep] for d in drawn]
            places = places[keep] if places is not None else None
    return out.reshape(n, m)


def signatures(registers: np.ndarray) -> np.ndarray:
    """Sixteen bits of each register, four registers (a band) to a number: shape (rows, BANDS)."""
    return (mix(registers.view(np.uint64)) >> np.uint64(48)).astype("<u2").view("<i8").reshape(len(registers), BANDS)


def digests(sets: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """A 256-bit digest of each row's sorted set; null for an empty one."""
    raw, ends = sets.astype("<u8").tobytes(), 8 * np.cumsum(sizes)
    return [hashlib.blake2b(raw[e - 8 * n : e], digest_size=32).digest() if n else None for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def short(digest: bytes) -> int:
    """64 bits of a digest, which tell the sets of one id apart."""
    return int.from_bytes(digest[:8], "big", signed=True)


def sketch(df: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """For each row: id, n_shingles, digest and signature of its set; the last two are null for an empty set."""
    narrow = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in slices(offsets):
                sets, sizes = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                flat = pa.array(signatures(super_minhash(sets, sizes)).reshape(-1))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(sizes) * BANDS + 1, BANDS, dtype=np.int32)), flat, mask=pa.array(sizes == 0))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(sizes, pa.int64()), pa.array(digests(sets, sizes), pa.binary()), lists], ["id", "n_shingles", "digest", "sig"])

    return narrow.mapInArrow(trimmed(run), f"id {narrow.schema['id'].dataType.simpleString()}, n_shingles bigint, digest binary, sig array<bigint>")


def full_sets(texts: DataFrame, k: int) -> DataFrame:
    """The sets of rows (id, t) as sorted 64-bit numbers, with the short digest ``d``; a task gives repeated rows once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set = set()
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in slices(offsets):
                sets, sizes = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                raw, ends = sets.astype("<u8").tobytes(), 8 * np.cumsum(sizes)
                rows = []
                for id_, digest, n, end in zip(batch.column(0).slice(i, j - i).to_pylist(), digests(sets, sizes), sizes.tolist(), ends.tolist(), strict=True):
                    if n and (id_, digest) not in given:
                        given.add((id_, digest))
                        rows.append((id_, short(digest), raw[end - 8 * n : end]))
                if rows:
                    a, b, c = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, batch.schema.field(0).type), pa.array(b, pa.int64()), pa.array(c, pa.binary())], ["id", "d", "set"])

    return texts.mapInArrow(trimmed(run), f"id {texts.schema['id'].dataType.simpleString()}, d bigint, set binary")


def alike(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    """Whether two sorted sets have 100 * common >= threshold * union."""
    if 100 * min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return False
    merged = np.sort(np.concatenate([a, b]))
    both = int(np.count_nonzero(merged[1:] == merged[:-1]))
    return 100 * both >= threshold * (len(merged) - both)


def in_common(sets: list[np.ndarray], split: int) -> np.ndarray:
    """How many elements each of the first ``split`` sets has in common with each of the others (if these are all sets, with each one but itself).

    Elements that many sets have are counted by products of 0/1 tables, the
    others by going through the pairs of sets that have them.
    """
    n = len(sets)
    begin = 0 if split == n else split
    out = np.zeros((split, n - begin), np.float32)
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    for dense in (False, True):
        wanted = (times > max(16, n // 16)) if dense else (times > 1) & (times <= max(16, n // 16))
        place = np.cumsum(wanted) - 1
        use = wanted[code]
        column = place[code[use]]
        order = np.argsort(column, kind="stable")
        own, column = row[use][order], column[order]
        if not len(column):
            continue
        if dense:
            width = max(64, CELLS // n)
            for low in range(0, int(column[-1]) + 1, width):
                i, j = np.searchsorted(column, [low, low + width])
                table = np.zeros((n, width), np.float32)
                table[own[i:j], column[i:j] - low] = 1
                out += table[:split] @ table[begin:].T
            continue
        ends = np.searchsorted(column, column, "right")  # each holder of an element meets those after it
        left = ends - np.arange(len(column)) - 1
        total = np.cumsum(left)
        for low in range(0, int(total[-1]), CELLS):
            i, j = np.searchsorted(total, [low, low + CELLS], "right")
            j = min(j + 1, len(left))
            first = np.repeat(np.arange(i, j), left[i:j])
            at = np.arange(len(first)) + (total[i] - left[i])
            keep = (at >= low) & (at < low + CELLS)
            second = first + 1 + at - (total - left)[first]
            a, b = own[first[keep]], own[second[keep]]
            if split < n:
                a, b = np.minimum(a, b), np.maximum(a, b)
                across = (a < split) & (b >= split)
                a, b = a[across], b[across] - split
            else:
                a, b = np.concatenate([a, b]), np.concatenate([b, a])
            out += np.bincount(a * out.shape[1] + b, minlength=out.size).reshape(out.shape)
    return out


def link_block(sets: list[np.ndarray], threshold: int, roots: list, side: list) -> list[int]:
    """Links documents of one task; returns for each the position of the first one it hangs together with.

    Equal ``roots`` are linked already. Where there are two sides, only
    documents of different sides are compared.
    """
    n = len(sets)
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    place: dict = {}
    root = np.array([place.setdefault(r, x) for x, r in enumerate(roots)])
    if len(place) > 1:
        order = np.array(sorted(range(n), key=lambda x: side[x] != side[0]))
        split = sum(s == side[0] for s in side)
        common = in_common([sets[x] for x in order], split)
        size = np.array([len(sets[x]) for x in order], np.float32)
        first, second = order[:split], order if split == n else order[split:]
        both = size[:split, None] + (size if split == n else size[split:])[None, :]
        linked = (100 * common >= threshold * (both - common)) & (root[first][:, None] != root[second][None, :])
        pairs = np.argwhere(linked)
        for a, b in np.unique(np.stack([root[first[pairs[:, 0]]], root[second[pairs[:, 1]]]], axis=1), axis=0).tolist():
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return [find(x) for x in root.tolist()]


def _in_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of rows that agree in the first ``keys`` columns; the rows come sorted by them."""
    waiting: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        own = list(zip(*[batch.column(c).to_pylist() for c in range(keys)], strict=True))
        begin = 0
        for r in range(batch.num_rows + 1):
            if r == batch.num_rows or own[r] != key:
                if r > begin:
                    waiting.append(batch.slice(begin, r - begin))
                if r < batch.num_rows:
                    if waiting:
                        yield pa.Table.from_batches(waiting)
                    waiting, key, begin = [], own[r], r
    if waiting:
        yield pa.Table.from_batches(waiting)


def first_links(members: DataFrame, sets: DataFrame, threshold: int, id_type: str) -> DataFrame:
    """Links (u, v) between the documents (id, d) of a bucket and its smallest one (first, first_d).

    About ``SPAN`` documents of a smallest one make a run, with a copy of that
    one's set ahead of their own, so tasks hold one set and read the others one
    by one.
    """
    runs = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("docs") / SPAN)))).cast("int")
    ties = members.where("id <> first").groupBy("first", "first_d", "id", "d").agg(F.max("docs").alias("docs"))
    dealt = ties.withColumn("run", F.pmod(F.xxhash64("id", "d"), runs).cast("int"))
    members = dealt.join(sets, ["id", "d"]).select("first", "first_d", "run", F.lit(1).alias("member"), "id", "set")
    heads = dealt.select("first", "first_d", "run").distinct().join(sets.withColumnsRenamed({"id": "first", "d": "first_d"}), ["first", "first_d"])
    heads = heads.select("first", "first_d", "run", F.lit(0).alias("member"), F.col("first").alias("id"), "set")
    rows = heads.unionByName(members).repartition("first", "first_d", "run").sortWithinPartitions("first", "first_d", "run", "member", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            found: list[tuple] = []
            for first, _, _, member, id_, raw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                numbers = np.frombuffer(raw, "<u8")
                if not member:
                    head, own = first, numbers
                elif alike(own, numbers, threshold):
                    found.append((head, id_))
            kind = batch.schema.field("id").type
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind) for k in (0, 1)], ["u", "v"])

    return rows.mapInArrow(trimmed(run), f"u {id_type}, v {id_type}")


def further_links(open_: DataFrame, sets: DataFrame, threshold: int, id_type: str, block: int) -> DataFrame:
    """Links (u, v) that open buckets (rows band, id, d, root) still hide."""
    of = F.xxhash64("id", "d")
    bands = open_.join(sets.select("id", "d", (F.octet_length("set") / 8).alias("n")), ["id", "d"]).groupBy("band").agg(F.count("*").alias("docs"), F.sum("n").alias("n"), F.bit_xor(of).alias("x"), F.bit_xor(F.xxhash64(of)).alias("y"))
    parts = F.greatest(F.ceil(F.col("docs") / block), F.ceil(F.col("n") / BLOCK_SHINGLES)).cast("int")
    once = bands.groupBy("docs", "x", "y").agg(F.min("band").alias("band"), F.max(parts).alias("parts"))
    rows = open_.join(once.select("band", "parts"), "band").withColumn("part", F.pmod(of, F.col("parts")).cast("int"))
    pairs = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = pairs.select("band", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "id", "d", "root")
    dealt = pairs.join(sets, ["id", "d"]).select("band", "a", "b", "part", "id", "root", "set").repartition("band", "a", "b").sortWithinPartitions("band", "a", "b", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _in_groups(batches, 3):
            own = [np.frombuffer(v, "<u8") for v in t.column("set").to_pylist()]
            at = link_block(own, threshold, t.column("root").to_pylist(), t.column("part").to_pylist())
            ids = t.column("id").combine_chunks()
            linked = [x for x, y in enumerate(at) if x != y]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(linked, pa.int64())), ids.take(pa.array([at[x] for x in linked], pa.int64()))], ["u", "v"])

    return dealt.mapInArrow(trimmed(run), f"u {id_type}, v {id_type}")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: int = 80, block: int = BLOCK) -> DataFrame:
    """Links documents whose sets of k-word shingles have 100 * common >= threshold * union (threshold of 80 or more).

    Returns one row for each row of ``df``: ``id_col``, ``n_shingles``,
    ``component_id`` (the smallest id that can be reached by links, its own
    included) and ``kept`` (whether that is its own). A text of fewer than k
    words, but not none, is one shingle. Null, empty and blank texts have no
    shingle and no links. A row with a null id takes no part: null component,
    kept. Rows that repeat an id with the same text share everything; an id
    with several texts counts as one document with several sets.

    Texts are read twice (once for sketches, once for candidates); only
    candidates' texts are shuffled, once, and from then on their sets.
    """
    spark = df.sparkSession
    bounded(spark)
    folder = shared_folder(spark)
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    id_type = docs.schema["id"].dataType.simpleString()
    whole = stored(sketch(docs, "id", "t", k), folder, "sketch")
    usable = whole.where("n_shingles > 0 and id is not null")
    reps = stored(usable.groupBy("digest").agg(F.min("id").alias("rep")), folder, "reps")
    chosen = usable.join(reps.select(F.col("rep").alias("id"), "digest"), ["id", "digest"], "left_semi")
    d = F.conv(F.substring(F.hex("digest"), 1, 16), 16, -10).cast("bigint")
    entries = chosen.select("id", d.alias("d"), F.posexplode("sig").alias("place", "value")).select(F.xxhash64("place", "value").alias("band"), "id", "d")
    # Several sets of one id hang together as they are, so buckets of one id need no look.
    shared = entries.groupBy("band").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.min_by("d", "id").alias("first_d"), F.count("*").alias("docs")).where("first <> last").select("band", "first", "first_d", "docs")
    members = stored(entries.join(shared, "band").distinct(), folder, "members")
    if members.isEmpty():
        joined = reps.select(F.col("rep").alias("id"), F.col("rep").alias("root")).limit(0)
    else:
        candidates = stored(members.select("id").distinct(), folder, "candidates")
        # Only rows that may be candidates are shuffled; the join decides.
        near, _ = split(docs, stored(bit_table(candidates, "id"), folder, "bits"), F.col("id"))
        sets = stored(full_sets(near.join(candidates, "id"), k).groupBy("id", "d").agg(F.first("set").alias("set")), folder, "sets")
        links = stored(first_links(members, sets, threshold, id_type), folder, "links")
        local = stored(components(links, f"{folder}/local"), folder, "local_roots")
        rooted = members.join(local.withColumnRenamed("root", "known"), "id", "left").select("band", "id", "d", F.coalesce("known", "id").alias("root"))
        unsettled = rooted.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("band")
        open_ = stored(rooted.join(unsettled, "band"), folder, "open")
        joined = local
        if not open_.isEmpty():
            more = stored(further_links(open_, sets, threshold, id_type, block), folder, "more_links")
            joined = components(links.union(more), f"{folder}/joined")
    # An id with several sets may stand in several rows here; the smallest root holds.
    roots = joined.select(F.col("id").alias("rep"), "root").groupBy("rep").agg(F.min("root").alias("root"))
    by_set = stored(reps.join(roots, "rep", "left").select("digest", F.coalesce("root", "rep").alias("component_id")), folder, "by_set")
    for name in ("reps", "members", "candidates", "bits", "sets", "links", "local", "local_roots", "open", "more_links", "joined"):
        drop(spark, f"{folder}/{name}")  # the result reads the sketch and by_set alone
    out = whole.select("id", "n_shingles", "digest").join(by_set, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.when(F.col("id").isNotNull(), F.col("component_id"))).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), (F.coalesce(F.col("id") == component, F.lit(True))).alias("kept"))
