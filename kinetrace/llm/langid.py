"""Language identification by a byte convolutional network.

Training (numpy, on the driver): filters of several widths over byte classes,
max pooling over a fixed-length window, then a softmax. Only the position that
won the pooling gets a gradient, so a step touches few weights. Training reads
all windows of the whole texts of a bounded sample of labelled rows; the bound
is a parameter.

Prediction: every byte of every text falls into one fixed-length window (the
last is padded), windows of many documents form one batch, and a document's
probabilities are the mean of its windows' by their length. Filters of width 2
to 4 are tables over byte pairs, so a position costs one or two lookups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetrace.llm.textcore import bounded, slices, trimmed, utf8

#: Bytes in a window, filter widths (2 to 4), filters of each width.
WINDOW, WIDTHS, FILTERS = 256, (2, 3, 4), 16
#: Most labelled rows that training reads.
TRAIN_ROWS = 2000
_CLASSES = 128


def byte_classes() -> np.ndarray:
    """Class of each byte: pad 0, letters without case, digits, blanks, other marks, and the bytes of longer characters."""
    table = np.empty(256, np.int64)
    for b in range(256):
        if 0x41 <= b & 0xDF <= 0x5A:
            table[b] = 1 + (b & 0xDF) - 0x41
        elif b < 0x80:
            table[b] = 27 if chr(b).isdigit() else 28 if b in (9, 10, 13, 32) else 29
        elif b < 0xC0:
            table[b] = 30 + b - 0x80
        else:
            table[b] = 94 + (b - 0xC0) // 2 if b >= 0xC8 else 119 + b - 0xC0
    return table


_TABLE = byte_classes()


@dataclass
class ByteCNN:
    """Weights by width: (width, class, filter); bias, output weights and bias; languages in order."""

    filters: dict[int, np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    langs: list[str]

    def pair_tables(self) -> dict[int, list[np.ndarray]]:
        """Each filter bank as tables over pairs of classes, or one class, from left to right."""
        tables = {}
        for w, k in self.filters.items():
            parts = []
            for j in range(0, w, 2):
                parts.append((k[j][:, None, :] + k[j + 1][None, :, :]).reshape(_CLASSES * _CLASSES, -1) if j + 1 < w else k[j])
            tables[w] = [np.ascontiguousarray(p, np.float32) for p in parts]
        return tables

    def windows(self, classes: np.ndarray, tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        """Probabilities for windows of byte classes, shape (windows, WINDOW)."""
        n, size = classes.shape
        pairs = classes[:, :-1] * _CLASSES + classes[:, 1:]
        pooled = []
        for w, parts in tables.items():
            m = size - w + 1
            total = np.take(parts[0], pairs[:, :m], axis=0)
            if len(parts) > 1:
                second = pairs[:, 2 : 2 + m] if w % 2 == 0 else classes[:, 2 : 2 + m]
                total += np.take(parts[1], second, axis=0)
            pooled.append(total.max(axis=1))
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
        z = hidden @ self.out + self.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all rows as byte classes; each window's row and length."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    rows = np.repeat(np.arange(len(sizes)), counts)
    first = np.cumsum(counts) - counts
    at = (np.arange(len(rows)) - first[rows]) * WINDOW
    lengths = np.minimum(sizes[rows] - at, WINDOW)
    out = np.zeros(len(rows) * WINDOW, np.int64)
    begin = np.repeat(first * WINDOW - offsets[:-1], sizes)
    out[np.arange(len(data)) + begin] = _TABLE[data]
    return out.reshape(-1, WINDOW), rows, lengths


def train(texts: list[str], labels: list[str], seed: int = 7, epochs: int = 4, rate: float = 0.01, batch: int = 64, steps: int = 400) -> ByteCNN | None:
    """Fits the network to all windows of the texts, in ``epochs`` passes or ``steps`` steps, what is more; None without a labelled text."""
    kept = [(t, y) for t, y in zip(texts, labels, strict=True) if t and y is not None]
    if not kept:
        return None
    langs = sorted({y for _, y in kept})
    rng = np.random.default_rng(seed)
    data, offsets = utf8(pa.array([t for t, _ in kept], pa.large_string()))
    parts, ys, place = [], [], {y: k for k, y in enumerate(langs)}
    of = np.array([place[y] for _, y in kept])
    for i, j in slices(offsets):
        classes, rows, _ = cut(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        parts.append(classes.astype(np.uint8))
        ys.append(of[rows + i])
    x, y = np.concatenate(parts), np.concatenate(ys)
    epochs = max(epochs, -(-steps * batch // len(y)))
    weight = len(y) / (len(langs) * np.maximum(1, np.bincount(y, minlength=len(langs))))
    weight = np.minimum(weight, 4.0)
    model = ByteCNN({w: rng.normal(0, 0.3, (w, _CLASSES, FILTERS)) for w in WIDTHS}, np.zeros(FILTERS * len(WIDTHS)), rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(langs))), np.zeros(len(langs)), langs)
    params = [*model.filters.values(), model.bias, model.out, model.out_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for b in range(0, len(y), batch):
            part = order[b : b + batch]
            xb, yb, n = x[part].astype(np.int64), y[part], len(part)
            tables, pairs = model.pair_tables(), xb[:, :-1] * _CLASSES + xb[:, 1:]
            pooled, won = [], []
            for w in WIDTHS:
                m = WINDOW - w + 1
                total = np.take(tables[w][0], pairs[:, :m], axis=0)
                if len(tables[w]) > 1:
                    total = total + np.take(tables[w][1], pairs[:, 2 : 2 + m] if w % 2 == 0 else xb[:, 2 : 2 + m], axis=0)
                at = total.argmax(axis=1)
                won.append(at)
                pooled.append(np.take_along_axis(total, at[:, None, :], 1)[:, 0])
            pre = np.concatenate(pooled, axis=1) + model.bias
            hidden = np.maximum(pre, 0)
            z = hidden @ model.out + model.out_bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), yb] -= 1
            p *= (weight[yb] / n)[:, None]
            back = (p @ model.out.T) * (pre > 0)
            grads: list[np.ndarray] = []
            for i, w in enumerate(WIDTHS):
                g = np.zeros_like(model.filters[w])
                part_back = back[:, i * FILTERS : (i + 1) * FILTERS]
                for j in range(w):
                    np.add.at(g[j], (np.take_along_axis(xb, won[i] + j, 1), np.arange(FILTERS)[None, :]), part_back)
                grads.append(g)
            grads += [back.sum(0), hidden.T @ p, p.sum(0)]
            step += 1
            for k, g in enumerate(grads):
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                params[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return model


def predict(model: ByteCNN | None, column: pa.Array, tables: dict[int, list[np.ndarray]] | None = None) -> tuple[list[str], list[float]]:
    """Language and its probability for each text; ``und`` and 0 where a text is null or has no letter."""
    n = len(column)
    if model is None:
        return ["und"] * n, [0.0] * n
    tables = tables or model.pair_tables()
    data, offsets = utf8(column)
    total = np.zeros((n, len(model.langs)))
    for i, j in slices(offsets, 1 << 19):
        classes, rows, lengths = cut(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        for k in range(0, len(rows), 128):
            p = model.windows(classes[k : k + 128], tables)
            np.add.at(total, rows[k : k + 128] + i, p * lengths[k : k + 128, None])
    letter = np.array([any(map(str.isalpha, v.as_py() or "")) for v in column], bool)
    share = total / np.maximum(total.sum(axis=1, keepdims=True), 1e-9)
    best = share.argmax(axis=1) if n else np.zeros(0, int)
    return [model.langs[b] if ok else "und" for b, ok in zip(best, letter, strict=True)], [float(min(1.0, share[r, b])) if ok else 0.0 for r, (b, ok) in enumerate(zip(best, letter, strict=True))]


def fit(df: DataFrame, where: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", rows: int = TRAIN_ROWS) -> ByteCNN | None:
    """Trains on the whole texts of at most ``rows`` rows of ``df`` that hold ``where`` and have a language.

    They are those with the least hashes of id, text and language, the same in
    every run; of rows that repeat all three one counts. Null ids, texts or
    languages are left out; without a row the model is None.
    """
    pool = df.where(where & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull())
    n = pool.count()
    pool = pool.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"), F.col(lang_col).cast("string").alias("l")).where("t is not null")
    key = F.xxhash64("i", "t", "l")
    # About twice the wanted rows get through, so that no task sends many to the final choice.
    few = pool.where(F.pmod(key, F.lit(1 << 30)) < int((1 << 30) * min(1.0, 2 * rows / max(n, 1)))).distinct()
    got = few.orderBy(F.pmod(key, F.lit(1 << 30)), "i", "t", "l").limit(rows).collect()
    got.sort(key=lambda r: (r.i, r.t, r.l))
    return train([r.t for r in got], [r.l for r in got])


def identify(df: DataFrame, model: ByteCNN | None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the columns ``keep``, ``lang_pred`` and ``score`` for each whole text, in a narrow pass.

    A null text or one without letters is ``und`` with score 0; so is every
    text if there is no model. One row out for each row in, null ids too.
    """
    bounded(df.sparkSession)
    shipped = df.sparkSession.sparkContext.broadcast(model)
    others = [c for c in keep if c != text_col]
    narrow = df.select(F.col(id_col).alias("c0"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(others, 1)], F.col(text_col).cast("string").alias("t"))
    passed = [f"c{k}" for k in range(len(others) + 1)] + ["t"] * (text_col in keep)
    schema = ", ".join([f"{c} {narrow.schema[c].dataType.simpleString()}" for c in passed] + ["lang_pred string, score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shipped.value
        tables = net.pair_tables() if net else None
        for b in batches:
            langs, scores = predict(net, b.column(b.num_columns - 1), tables)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(passed)], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*passed, "lang_pred", "score"])

    place = {c: f"c{k}" for k, c in enumerate(others, 1)} | {text_col: "t"}
    out = narrow.mapInArrow(trimmed(run), schema)
    return out.select(F.col("c0").alias(id_col), *[F.col(place[c]).alias(c) for c in keep], "lang_pred", "score")
