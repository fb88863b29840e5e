"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of whole documents of a few megabytes. Its words, with a
separator of its own after each document, become one sequence of symbols; the
sequence is suffix-sorted, and the index keeps its Burrows-Wheeler transform as
a wavelet matrix of bit vectors with rank directories, and the suffix positions
of every 16th symbol. All test phrases search the shard together, last word
first, and drop out when their range is empty. What is found is located by
walking to the next sampled position, compared with the phrase byte by byte,
and merged into spans of words to remove.

Test phrases are dealt into blocks of bounded size by executors and written to
the shared folder. A worker holds one block at a time, as arrays; the driver
sees only where blocks lie.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetrace.llm.textcore import bounded, byte_table, hashed_words, located, lower_ascii, slices, trimmed, utf8
from kinetrace.sources.stage import shared_folder, stored

#: Words in a window; bytes of a shard; bytes of test phrases held at once; distance of sampled suffix positions.
WINDOW, SHARD_BYTES, BLOCK_BYTES, SAMPLE = 10, 3 << 20, 4 << 20, 16
#: Windows that search a shard together, and occurrences (or bytes of them) that are located and compared together.
SEARCHED, PIECE = 1 << 16, 1 << 19
#: Word bytes once A-Z are lower-cased: 0-9, a-z, and all bytes of characters outside ASCII.
WORD = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes; ``seq`` ends with a symbol that occurs once.

    Sorts by up to four symbols, then doubles the compared length, each time
    only where ties are left.
    """
    n = len(seq)
    width = max(1, int(seq.max()).bit_length())
    depth = max(1, min(4, 63 // width))
    padded = np.concatenate([seq, np.zeros(depth, seq.dtype)]).astype(np.int64)
    key = np.zeros(n, np.int64)
    for j in range(depth):
        key = key << width | padded[j : j + n]
    order = np.argsort(key)
    ordered = key[order]
    head = np.empty(n, bool)
    head[0], head[1:] = True, ordered[1:] != ordered[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    alone = head.copy()
    alone[:-1] &= head[1:]
    slots = np.flatnonzero(~alone)
    while len(slots):
        at = order[slots]
        key = rank[at] << 32 | rank[np.minimum(at + depth, n - 1)]
        turn = np.argsort(key)
        key, at = key[turn], at[turn]
        order[slots] = at
        head = np.empty(len(at), bool)
        head[0], head[1:] = True, key[1:] != key[:-1]
        rank[at] = slots[np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))]
        alone = head.copy()
        alone[:-1] &= head[1:]
        slots = slots[~alone]
        depth *= 2
    return order


class BitRank:
    """A bit vector with a count before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Rank and access on a sequence of symbols, a bit of the symbol per level."""

    def __init__(self, seq: np.ndarray):
        self.n, self.depth = len(seq), max(1, int(seq.max()).bit_length())
        self.levels: list[tuple[int, BitRank, int]] = []
        for shift in range(self.depth - 1, -1, -1):
            bits = (seq >> shift & 1).astype(bool)
            self.levels.append((shift, BitRank(bits), self.n - int(np.count_nonzero(bits))))
            seq = np.concatenate([seq[~bits], seq[bits]])

    def rank(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands among the first i."""
        lo = np.zeros(len(i), np.int64)
        for shift, bits, zeros in self.levels:
            one = (symbols >> shift & 1).astype(bool)
            a, b = bits.rank(lo), bits.rank(i)
            lo, i = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, i - b)
        return i - lo

    def get(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        for shift, bits, zeros in self.levels:
            one, ones = bits.get(i), bits.rank(i)
            out |= one.astype(np.int64) << shift
            i = np.where(one, zeros + ones, i - ones)
        return out


class FMIndex:
    """Counts and locates runs of symbols in a sequence whose last symbol occurs once."""

    def __init__(self, seq: np.ndarray):
        order = suffix_order(seq)
        self.matrix = WaveletMatrix(seq[order - 1])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq))])
        sampled = order % SAMPLE == 0
        self.sampled, self.positions = BitRank(sampled), order[sampled]

    def search(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that start with each row of ``symbols`` (left-aligned; -1: not in the sequence)."""
        lo, hi = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.matrix.n, np.int64)
        for step in range(symbols.shape[1] - 1, -1, -1):
            live = np.flatnonzero((lengths > step) & (lo < hi))
            s = symbols[live, step]
            lo[live[s < 0]] = hi[live[s < 0]] = 0
            live, s = live[s >= 0], s[s >= 0]
            if len(live):
                lo[live], hi[live] = self.first[s] + self.matrix.rank(s, lo[live]), self.first[s] + self.matrix.rank(s, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes: walk back until a sampled one, and count the steps."""
        rows, out = rows.copy(), np.empty(len(rows), np.int64)
        left, steps = np.arange(len(rows)), 0
        while len(left):
            at = rows[left]
            done = self.sampled.get(at)
            out[left[done]] = self.positions[self.sampled.rank(at[done])] + steps
            left, at = left[~done], at[~done]
            s = self.matrix.get(at)
            rows[left] = self.first[s] + self.matrix.rank(s, at)
            steps += 1
        return out


@dataclass
class Phrases:
    """A block of items: their lower-cased text, the words' hashes and places in it, and the distinct windows.

    A window is a first word and a length; windows of equal words are one, with
    the items that hold it in ``owners[owned[w] : owned[w + 1]]``. ``alike``
    says that two different words of the block have one hash.
    """

    raw: bytes
    codes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    lengths: np.ndarray
    owned: np.ndarray
    owners: np.ndarray
    names: list[str]
    alike: bool

    @staticmethod
    def of(items: list[tuple[str, str | None]], window: int) -> Phrases:
        data, offsets = utf8(pa.array([t or "" for _, t in items], pa.large_string()))
        low = lower_ascii(data)
        starts, ends, counts, codes = hashed_words(low, offsets, WORD)
        windows = np.where(counts > 0, np.maximum(1, counts - window + 1), 0)
        item = np.repeat(np.arange(len(items)), windows)
        begin = np.cumsum(counts) - counts
        first = begin[item] + np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows)
        lengths = np.minimum(counts[item], window)
        raw = low.tobytes()
        numbers: dict[bytes, int] = {}
        word = np.array([numbers.setdefault(raw[s:e], len(numbers)) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)], np.int32)
        step = np.arange(window)
        table = np.where(step < lengths[:, None], word[np.minimum(first[:, None] + step, max(0, len(word) - 1))] if len(word) else 0, -1).astype(np.int32)
        if len(table):
            keys = np.ascontiguousarray(table).view(np.dtype((np.void, table.dtype.itemsize * window))).ravel()
            _, at, group = np.unique(keys, return_index=True, return_inverse=True)
        else:
            at, group = np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(group.astype(np.int64) * max(1, len(items)) + item)
        owners = pairs % max(1, len(items))
        owned = np.searchsorted(pairs, np.arange(len(at) + 1) * max(1, len(items)))
        return Phrases(raw, codes, starts.astype(np.int32), ends.astype(np.int32), first[at].astype(np.int32), lengths[at].astype(np.int32), owned.astype(np.int32), owners.astype(np.int32), [i for i, _ in items], len(np.unique(codes)) < len(numbers))

    def words(self, window: int) -> list[bytes]:
        a, n = int(self.first[window]), int(self.lengths[window])
        return [self.raw[s:e] for s, e in zip(self.starts[a : a + n].tolist(), self.ends[a : a + n].tolist(), strict=True)]

    def items(self, window: int) -> tuple[str, ...]:
        """Names of the items that hold a window."""
        return tuple(self.names[k] for k in self.owners[self.owned[window] : self.owned[window + 1]].tolist())


def _unlike(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, symbols: np.ndarray, known: dict[int, bytes]) -> np.ndarray:
    """Flags of a shard's words whose symbol is that of a test word, but not the bytes: another word with the same hash."""
    wrong = np.zeros(len(symbols), bool)
    at = np.flatnonzero(np.isin(symbols, np.fromiter(known, np.int64, len(known))))
    at = at[np.argsort(symbols[at], kind="stable")]
    edges = np.flatnonzero(np.diff(symbols[at], prepend=-1))
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(at)], strict=True):
        word = np.frombuffer(known[int(symbols[at[a]])], np.uint8)
        own = at[a:b]
        same = ends[own] - starts[own] == len(word)
        for c in range(0, len(own), PIECE // (len(word) + 1) + 1):
            part = own[c : c + PIECE // (len(word) + 1) + 1]
            read = low[np.minimum(starts[part][:, None] + np.arange(len(word)), len(low) - 1)]
            same[c : c + len(part)] &= (read == word).all(axis=1)
        wrong[own[~same]] = True
    return wrong


def scan_shard(low: np.ndarray, offsets: np.ndarray, blocks: Iterator[Phrases]) -> tuple[np.ndarray, np.ndarray, dict[int, list[str]], np.ndarray, np.ndarray]:
    """Searches one shard of lower-cased documents.

    Returns the words of each document, a flag for each word that an occurrence
    covers, the items found in each document, and the words' start and end
    bytes. Each distinct window is searched once; its occurrences are located,
    confirmed and marked together, a bounded number at a time.
    """
    starts, ends, counts, codes = hashed_words(low, offsets, WORD)
    docs, n = len(counts), len(codes)
    hit = np.zeros(n + 1, np.int64)
    found_in: dict[int, list[tuple[str, ...]]] = {}
    if n == 0:
        return counts, hit[:0].astype(bool), {}, starts, ends
    vocabulary, symbols = np.unique(codes, return_inverse=True)
    row = np.repeat(np.arange(docs), counts)
    place = np.arange(n) + row  # a separator stands after each document
    seq = np.empty(n + docs, np.int64)
    seq[place] = symbols + docs
    seq[np.cumsum(counts) + np.arange(docs)] = np.arange(docs)
    index = FMIndex(seq)
    after = np.cumsum(counts + 1)
    for phrases in blocks:
        near = np.minimum(np.searchsorted(vocabulary, phrases.codes), len(vocabulary) - 1)
        known = vocabulary[near] == phrases.codes
        symbol = np.where(known, near + docs, -1)
        missing = np.concatenate([[0], np.cumsum(~known)])
        # Windows with a word that the shard lacks need no search.
        live = np.flatnonzero(missing[phrases.first + phrases.lengths] == missing[phrases.first])
        for low_at in range(0, len(live), SEARCHED):
            own = live[low_at : low_at + SEARCHED]
            size = phrases.lengths[own]
            step = np.arange(int(size.max()))
            table = np.where(step < size[:, None], symbol[np.minimum(phrases.first[own][:, None] + step, len(symbol) - 1)], -1)
            lo, hi = index.search(table, size)
            found = np.flatnonzero(lo < hi)
            if not len(found):
                continue
            taken = np.unique(np.concatenate([np.arange(a, a + k) for a, k in zip(phrases.first[own[found]].tolist(), size[found].tolist(), strict=True)]))
            test_words = {int(near[w]): phrases.raw[phrases.starts[w] : phrases.ends[w]] for w in taken.tolist()}
            wrong = np.concatenate([[0], np.cumsum(_unlike(low, starts, ends, symbols, test_words))])
            times = (hi - lo)[found]
            total = np.cumsum(times)
            begin = 0
            while begin < len(found):
                # Windows of together a bounded number of occurrences; one with more is a piece by itself.
                end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + PIECE, "right")))
                part, k = found[begin:end], times[begin:end]
                window = np.repeat(own[part], k)
                rows = np.arange(len(window)) - np.repeat(np.cumsum(k) - k, k) + np.repeat(lo[part], k)
                position = index.locate(rows)
                word = position - np.searchsorted(after, position, "right")
                length = phrases.lengths[window].astype(np.int64)
                if not phrases.alike:
                    right = wrong[word + length] == wrong[word]
                else:  # two test words share a hash, so each occurrence is compared by itself
                    right = np.array([[low[starts[w + j] : ends[w + j]].tobytes() for j in range(m)] == phrases.words(p) for p, w, m in zip(window.tolist(), word.tolist(), length.tolist(), strict=True)], bool)
                window, word, length = window[right], word[right], length[right]
                hit[: n + 1] += np.bincount(word, minlength=n + 1) - np.bincount(word + length, minlength=n + 1)
                met = np.unique(row[word] * np.int64(len(phrases.first)) + window)
                names: dict[int, tuple[str, ...]] = {}
                for r, w in zip((met // len(phrases.first)).tolist(), (met % len(phrases.first)).tolist(), strict=True):
                    if w not in names:
                        names[w] = phrases.items(w)
                    found_in.setdefault(r, []).append(names[w])
                begin = end
    # Documents with the same windows share one list.
    shared: dict[tuple[int, ...], list[str]] = {}
    items = {}
    for r, lists in found_in.items():
        key = tuple(map(id, lists))
        if key not in shared:
            shared[key] = sorted(set().union(*lists))
        items[r] = shared[key]
    return counts, np.cumsum(hit[:-1]) > 0, items, starts, ends


def phrase_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int) -> list[tuple[str, int]]:
    """Writes the test phrases as blocks of about ``block_bytes`` of text; the files and numbers of the blocks.

    A sum over the table fixes the blocks' number; an item goes to one by a
    hash, repeated rows once. An item is never cut, so a block is at least as large as its longest.
    """
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).where("i is not null and t is not null").distinct()
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = int(size // block_bytes) + 1
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("i", "t"), F.lit(parts)).cast("int")).repartition(parts, "part").sortWithinPartitions("part", "i", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(part: int, items: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([pickle.dumps(Phrases.of(items, window))], pa.binary())], ["part", "block"])

        part, items = None, []
        for batch in batches:
            for i, t, p in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if p != part and items:
                    yield block(part, items)
                    items = []
                part = p
                items.append((i, t))
        if items:
            yield block(part, items)

    made = stored(dealt.mapInArrow(trimmed(run), "part int, block binary"), shared_folder(spark), "phrases")
    return [(r.file, r.part) for r in made.select(F.input_file_name().alias("file"), "part").orderBy("part").collect()]


_held: list = [None, None]  # the block that this worker process read last, under its place


def load(place: tuple[str, int]) -> Phrases:
    """One block from the shared folder; the one before it goes."""
    if _held[0] != place:
        _held[:] = [None, None]
        system, path = located(unquote(place[0]))
        with system.open_input_file(path) as f:
            table = pq.ParquetFile(f)
            for k in range(table.num_row_groups):
                group = table.read_row_group(k, columns=["part"]).column("part").to_pylist()
                if place[1] in group:
                    found = table.read_row_group(k, columns=["block"]).column("block")[group.index(place[1])]
                    _held[:] = [place, pickle.loads(found.as_py())]
                    break
            else:
                raise FileNotFoundError(f"no block {place[1]} in {place[0]}")
    return _held[1]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, keep: tuple[str, ...] = (), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Finds benchmark windows in whole documents, in a narrow pass over them.

    A window is ``window`` consecutive words of an item; an item of fewer words,
    but not none, is one window. Returns for each row of ``docs``: ``id_col``,
    the columns ``keep``, ``n_words``, ``n_hit`` (words that an occurrence
    covers), ``items`` (sorted ids of items with an occurring window), ``spans``
    (merged runs of hit words: first word, end word, first and end byte) and
    ``clean_text`` (the text without its spans; the text itself if there is
    none).

    Null text: no words, and null ``clean_text``. Items with a null id or text
    are passed over. Ids may be null or repeat; each row is judged by itself.
    A document longer than a shard is a shard by itself, so memory follows the
    longest document. With several blocks of test phrases each shard reads them
    one after the other.
    """
    bounded(docs.sparkSession)
    blocks = phrase_blocks(benchmark, item_col, item_text_col, window, block_bytes)
    narrow = docs.select(F.col(id_col).alias("c0"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(keep, 1)], F.col(text_col).cast("string").alias("t"))
    kinds = [narrow.schema[f"c{k}"].dataType.simpleString() for k in range(len(keep) + 1)]
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("start_byte", pa.int32()), ("end_byte", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            data, offsets = utf8(texts)
            for i, j in slices(offsets, SHARD_BYTES):
                own, base = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                counts, hit, items, starts, ends = scan_shard(lower_ascii(own), base, map(load, blocks))
                first = np.cumsum(counts) - counts
                hits = np.bincount(np.repeat(np.arange(len(counts)), counts)[hit], minlength=len(counts)) if len(hit) else np.zeros(len(counts), np.int64)
                spans: list[list[dict]] = [[] for _ in counts]
                clean = texts.slice(i, j - i).to_pylist() if items else None
                for r in items:
                    flags = np.concatenate([[False], hit[first[r] : first[r] + counts[r]], [False]])
                    edges = np.flatnonzero(flags[1:] != flags[:-1])
                    kept, at = [], int(base[r])
                    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                        s, e = int(starts[first[r] + a]), int(ends[first[r] + b - 1])
                        spans[r].append({"start": a, "end": b, "start_byte": s - int(base[r]), "end_byte": e - int(base[r])})
                        kept.append(own[at:s].tobytes())
                        at = e
                    clean[r] = b"".join([*kept, own[at : base[r + 1]].tobytes()]).decode()
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.slice(i, j - i) for c in batch.columns[:-1]],
                        pa.array(counts, pa.int64()),
                        pa.array(hits, pa.int64()),
                        pa.array([items.get(r, ()) for r in range(j - i)], pa.list_(pa.string())),
                        pa.array(spans, pa.list_(span)),
                        pa.array(clean, pa.string()) if clean is not None else texts.slice(i, j - i),
                    ],
                    [*batch.schema.names[:-1], "n_words", "n_hit", "items", "spans", "clean_text"],
                )

    schema = ", ".join([f"c{k} {kind}" for k, kind in enumerate(kinds)] + ["n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:int,end:int,start_byte:int,end_byte:int>>, clean_text string"])
    return narrow.mapInArrow(trimmed(run), schema).toDF(id_col, *keep, "n_words", "n_hit", "items", "spans", "clean_text")
