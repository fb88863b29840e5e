"""License scans by a positional index of rare words.

Templates are short word sequences of licence notices. Their words form a small
vocabulary whose document frequencies are counted over the whole corpus. The
index holds, for each word, the templates and offsets where it stands. A text's
licence words are looked up from the highest inverse document frequency down:
an alignment that is to reach a template's least share must match one of the
template's rarest words whose weights exceed what may be missing, so only those
are looked up and no alignment is lost. Each look-up proposes where a template
would begin; the postings of its other words at the same relative position give
the share of weight that is matched, and the template's mandatory key phrases
must stand there word by word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetrace.llm.textcore import bounded, byte_table, hashed_words, hashes, lower_ascii, slices, trimmed, utf8

WORD = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


@dataclass(frozen=True)
class Template:
    """A notice: its label, words, key phrases that have to be there, and the least share (in per cent) of weight to match."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    least: int = 80

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def key_places(self) -> list[int]:
        """Offsets of all words of the key phrases, which are parts of the text."""
        own, places = self.words, set()
        for key in map(str.split, self.keys):
            at = next(k for k in range(len(own)) if own[k : k + len(key)] == key)
            places |= set(range(at, at + len(key)))
        return sorted(places)


#: The base phrases and their labels. All their words have to match.
BASE = (
    Template("cc-by", "cc by", ("cc by",), 100),
    Template("gpl", "general public license", ("general public license",), 100),
    Template("reserved", "all rights reserved", ("all rights reserved",), 100),
)
#: Notices that this method adds: usual wordings of public licences.
NOTICES = (
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license",)),
    Template("apache-2.0", "you may not use this file except in compliance with the license", ("except in compliance with the license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("source and binary forms",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc0", "this work is dedicated to the public domain under cc0 1 0", ("cc0",)),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    Template("gpl-2.0", "this work is licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee",)),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("hereby granted free of charge",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)
TEMPLATES = BASE + NOTICES
#: Alignments compared at once.
CANDIDATES = 1 << 16


def vocabulary(templates: Sequence[Template]) -> list[str]:
    return sorted({w for t in templates for w in t.words})


class Vocabulary:
    """Numbers of known words in a buffer of text; equal hashes are confirmed by the bytes."""

    def __init__(self, words: Sequence[str]):
        raw = [w.encode() for w in words]
        offsets = np.concatenate([[0], np.cumsum([len(w) for w in raw])]).astype(np.int64)
        codes = hashes(np.frombuffer(b"".join(raw), np.uint8), offsets[:-1], offsets[1:])
        self.order = np.argsort(codes)
        self.codes = codes[self.order]
        self.sizes = np.diff(offsets)
        self.width = int(self.sizes.max(initial=0))
        self.bytes = np.zeros((len(raw), self.width), np.uint8)
        for k, w in enumerate(raw):
            self.bytes[k, : len(w)] = np.frombuffer(w, np.uint8)

    def numbers(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for unknown ones."""
        out = np.full(len(codes), -1, np.int32)
        near = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        hit = np.flatnonzero(self.codes[near] == codes)
        number = self.order[near[hit]]
        for a in range(0, len(hit), CANDIDATES):
            own, n = hit[a : a + CANDIDATES], number[a : a + CANDIDATES]
            size = ends[own] - starts[own]
            at = starts[own][:, None] + np.arange(self.width)
            read = np.where(np.arange(self.width) < size[:, None], low[np.minimum(at, len(low) - 1)], 0)
            same = (size == self.sizes[n]) & (read == self.bytes[n]).all(axis=1)
            out[own[same]] = n[same]
        return out


def weights(documents: int, counts: dict[str, int], words: Sequence[str]) -> list[int]:
    """Inverse document frequencies in whole thousandths, at least 1000, so that sums do not depend on their order."""
    return [round(1000 * (math.log((documents + 1) / (counts.get(w, 0) + 1)) + 1)) for w in words]


class Index:
    """Postings of the templates' rarest words, and what is needed to compare an alignment."""

    def __init__(self, templates: Sequence[Template], words: Sequence[str], weight: Sequence[int]):
        self.templates, self.vocabulary = list(templates), Vocabulary(words)
        number = {w: k for k, w in enumerate(words)}
        self.words = [np.array([number[w] for w in t.words], np.int32) for t in templates]
        self.weight = [np.array([weight[k] for k in own], np.int64) for own in self.words]
        self.keys = [np.array(t.key_places(), np.int64) for t in templates]
        #: For each template (word, offset): the rarest words, down to where the rest could not reach the least share.
        self.postings: list[list[tuple[int, int]]] = []
        for t, own, w in zip(templates, self.words, self.weight, strict=True):
            total, taken, lookups = int(w.sum()), 0, []
            for j in sorted(range(len(own)), key=lambda j: (-w[j], j)):
                lookups.append((int(own[j]), j))
                taken += int(w[j])
                if 100 * (total - taken) < t.least * total:
                    break
            self.postings.append(lookups)

    def aligned(self, ids: np.ndarray, first: np.ndarray, after: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Template, rows, starts (words from the row's first) and shares of all alignments that hold.

        A notice may be cut off by the text's begin or end; its missing words then do not match.
        """
        known = np.flatnonzero(ids >= 0)
        known = known[np.argsort(ids[known], kind="stable")]
        edges = np.searchsorted(ids[known], np.arange(len(self.vocabulary.codes) + 1))
        for k, lookups in enumerate(self.postings):
            n = len(self.words[k])
            places = [(known[edges[w] : edges[w + 1]], j) for w, j in lookups]
            # A row and a start that may lie before it: start + n is never negative within the buffer.
            found = [np.stack([row[p].astype(np.int64), p - j], axis=1) for p, j in places if len(p)]
            if not found:
                continue
            pairs = np.concatenate(found)
            pairs = np.unique(pairs, axis=0) if len(found) > 1 else pairs
            for a in range(0, len(pairs), CANDIDATES):
                r, s = pairs[a : a + CANDIDATES].T
                at = s[:, None] + np.arange(n)
                inside = (at >= first[r][:, None]) & (at < after[r][:, None])
                match = inside & (ids[np.clip(at, 0, len(ids) - 1)] == self.words[k])
                got = match @ self.weight[k]
                total = int(self.weight[k].sum())
                good = (100 * got >= self.templates[k].least * total) & match[:, self.keys[k]].all(axis=1)
                yield k, r[good], s[good] - first[r[good]], got[good] / total


def _numbered(texts: pa.Array, known: Vocabulary) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows (from, to), their words' numbers, each word's row, and words a row."""
    data, offsets = utf8(texts)
    for i, j in slices(offsets):
        low, base = lower_ascii(data[offsets[i] : offsets[j]]), offsets[i : j + 1] - offsets[i]
        starts, ends, counts, codes = hashed_words(low, base, WORD)
        yield i, j, known.numbers(low, starts, ends, codes), np.repeat(np.arange(j - i), counts), counts


def document_counts(docs: DataFrame, words: Sequence[str], text_col: str = "text") -> tuple[int, dict[str, int]]:
    """The number of documents, and for each of the given words that of documents that hold it.

    Each task sends one row a word and batch, so what is shuffled does not grow
    with the length of texts; the driver gets a row for each of the words.
    """
    bounded(docs.sparkSession)
    size = len(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(words)
        for batch in batches:
            held = np.zeros(size + 1, np.int64)
            held[size] = batch.num_rows
            for _, _, ids, row, _ in _numbered(batch.column(0), known):
                hit = ids >= 0
                pairs = np.unique(row[hit].astype(np.int64) * size + ids[hit])
                held[:size] += np.bincount(pairs % size, minlength=size)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1), pa.int32()), pa.array(held)], ["word", "n"])

    rows = docs.select(F.col(text_col).cast("string")).mapInArrow(trimmed(run), "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"]: r["n"] for r in rows}
    return found.get(size, 0), {w: found.get(k, 0) for k, w in enumerate(words)}


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Licence notices of each document: its id, kept columns, n_words, matches and score.

    ``matches`` lists (label, start, n_words, share) by start, template and
    label; starts count words from 0, and one before the text's begin, where a
    notice is cut off, is negative. ``score`` is the greatest share, 0 without
    a match. Two passes read the texts: the first counts in how many documents
    each licence word stands, over all of them, the second looks notices up.

    A null text counts as empty and has no words; rows with null or repeated ids
    are judged like others; an empty table gives no rows. Only the named columns
    are read. Memory of a task follows the longest text.
    """
    words = vocabulary(templates)
    documents, counts = document_counts(docs, words, text_col)
    weight, templates = weights(documents, counts, words), tuple(templates)
    narrow = docs.select(F.col(id_col).alias("c0"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(keep, 1)], F.col(text_col).cast("string").alias("t"))
    kinds = [narrow.schema[f"c{k}"].dataType.simpleString() for k in range(len(keep) + 1)]
    fields = [("label", pa.string()), ("start", pa.int64()), ("n_words", pa.int32()), ("share", pa.float64())]
    labels, sizes = np.array([t.label for t in templates], object), np.array([len(t.words) for t in templates], np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates, words, weight)
        for batch in batches:
            for i, j, ids, row, counts in _numbered(batch.column(batch.num_columns - 1), index.vocabulary):
                after = np.cumsum(counts)
                hits = list(index.aligned(ids, after - counts, after, row)) if len(ids) else []
                template = np.concatenate([np.full(len(r), k, np.int64) for k, r, _, _ in hits] or [np.zeros(0, np.int64)])
                r, s, share = (np.concatenate([h[x] for h in hits] or [np.zeros(0)]) for x in (1, 2, 3))
                order = np.lexsort((template, s, r))
                template, r, s, share = template[order], r[order].astype(np.int64), s[order].astype(np.int64), share[order].astype(float)
                best = np.zeros(j - i)
                np.maximum.at(best, r, share)
                values = pa.StructArray.from_arrays([pa.array(labels[template].tolist(), pa.string()), pa.array(s), pa.array(sizes[template]), pa.array(share)], fields=[pa.field(*f) for f in fields])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(r, np.arange(j - i + 1)), pa.int32()), values)
                yield pa.RecordBatch.from_arrays([*[c.slice(i, j - i) for c in batch.columns[:-1]], pa.array(counts, pa.int64()), lists, pa.array(best)], [*batch.schema.names[:-1], "n_words", "matches", "score"])

    schema = ", ".join([f"c{k} {kind}" for k, kind in enumerate(kinds)] + ["n_words bigint, matches array<struct<label:string,start:bigint,n_words:int,share:double>>, score double"])
    return narrow.mapInArrow(trimmed(run), schema).toDF(id_col, *keep, "n_words", "matches", "score")


def oracle(templates: Sequence[Template] = TEMPLATES, base: Sequence[Template] = BASE) -> str:
    """DuckDB SQL of the query's result: every word of every template is joined to every place, without look-ups."""
    text = lambda v: "'" + v + "'"
    rows = [f"({k}, {j}, {text(w)}, {j in set(t.key_places())})" for k, t in enumerate(templates) for j, w in enumerate(t.words)]
    names = ", ".join(f"({k}, {text(t.label)}, {t.least}, {k < len(base)})" for k, t in enumerate(templates))
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH tw(t, j, word, must) AS (VALUES {", ".join(rows)}), tn(t, label, least, base) AS (VALUES {names}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
u AS (SELECT r, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM d),
own AS (SELECT * FROM u WHERE word IN (SELECT word FROM tw)),
df AS (SELECT word, count(DISTINCT r) AS n FROM own GROUP BY word),
idf AS (SELECT word, CAST(round(1000 * (ln(((SELECT count(*) FROM d) + 1) / (coalesce(n, 0) + 1)) + 1)) AS BIGINT) AS weight FROM (SELECT DISTINCT word FROM tw) LEFT JOIN df USING (word)),
tt AS (SELECT t, sum(weight) AS total, count(*) FILTER (WHERE must) AS musts FROM tw JOIN idf USING (word) GROUP BY t),
m AS (SELECT r, tw.t, pos - j AS s, sum(weight) AS got, count(*) FILTER (WHERE must) AS musts FROM own JOIN tw USING (word) JOIN idf USING (word) GROUP BY r, tw.t, pos - j),
h AS (SELECT r, s, label, base, got / total AS share FROM m JOIN tt USING (t) JOIN tn USING (t) WHERE 100 * got >= least * total AND m.musts = tt.musts),
b AS (SELECT r, count(*) FILTER (WHERE base) AS n_base, min(s) FILTER (WHERE base) AS a, max(s) FILTER (WHERE base) AS z,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM h GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(a AS BIGINT) AS first_word, CAST(z AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN b USING (r)
"""
