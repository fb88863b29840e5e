"""Toxic spans by a linear-chain conditional random field.

The field has two states over hashed features of a word, its beginnings and
end, and its neighbours. Labels are of documents, so a token's label is hidden:
a document is toxic if some token is. Training (numpy, on the driver) raises the
likelihood of the documents' labels under that rule, a small share of labels
being wrong. Its gradient is that of expectation-maximization: the field's own
marginals are the tokens' expected labels, pushed down in clean documents, and
in toxic ones up as far as no token explains the label yet. It reads the whole
texts of a bounded sample of labelled documents.

The marginals of a document, from the forward-backward recursions over all its
tokens, give the offending spans. Along the chain they also give the probability
that every token is clean, and so the document's score.

The recursions run over the ratio of the two states' messages. Rows are cut
into segments of 64 tokens that are worked on side by side: first each
segment's transfer matrix, then the ratios at segment borders from left to
right (and right to left), then the ratios inside; so results are those of one
pass over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetrace.llm.textcore import RangeHash, bounded, byte_table, lower_ascii, mix, release, salt, slices, trimmed, utf8, words

#: Most labelled documents of each class that training reads; steps of training that it takes at least.
TRAIN_ROWS, TRAIN_STEPS = 2000, 150
#: Size of the weight table; tokens in a segment; tokens of a training step.
BITS, SEGMENT, STEP_TOKENS = 18, 64, 64_000
#: Share of documents whose label is taken to be wrong.
NOISE = 0.02
_WORD = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
#: Features of a token: the word, its first bytes and last bytes, and the words beside it.
BEGINNINGS, ENDINGS = (3, 4, 5, 6, 8), (4,)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of words, words in each row, and the words' features: word, beginnings, endings, before, after."""
    low = lower_ascii(data)
    starts, ends, counts = words(low, offsets, _WORD)
    n = len(starts)
    out = np.zeros((n, 3 + len(BEGINNINGS) + len(ENDINGS)), np.int32)
    if n:
        hasher = RangeHash(low)
        word = hasher(starts, ends)
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        edge = np.zeros(n, bool)
        edge[first[counts > 0]] = True
        before, after = np.empty(n, np.uint64), np.empty(n, np.uint64)
        before[1:], after[:-1] = word[:-1], word[1:]
        before[edge] = 1
        after[np.append(np.flatnonzero(edge)[1:] - 1, n - 1)] = 2
        kinds = [word, *(hasher(starts, np.minimum(ends, starts + k)) for k in BEGINNINGS), *(hasher(np.maximum(starts, ends - k), ends) for k in ENDINGS), before, after]
        for k, h in enumerate(kinds):
            out[:, k] = (mix(h + salt(k + 1)) >> np.uint64(64 - BITS)).astype(np.int32)
    return starts, ends, counts, out


@dataclass
class Field:
    """Weights of features for the toxic state, bias, transitions (from, to) as logs, and what the log-odds of a score lose
    because the sample holds more toxic documents than the labelled rows do."""

    weights: np.ndarray
    bias: float
    moves: np.ndarray
    shift: float = 0.0

    def emissions(self, features: np.ndarray) -> np.ndarray:
        total = np.full(len(features), self.bias)
        for k in range(features.shape[1]):
            total += self.weights[features[:, k]]
        return np.clip(total, -30, 30)


def lay_out(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each token's cell in a table of segments, and each row's first segment and number of segments."""
    pieces = -(-counts // SEGMENT)
    first = np.cumsum(pieces) - pieces
    begin = np.cumsum(counts) - counts
    cell = np.arange(counts.sum()) + np.repeat(first * SEGMENT - begin, counts)
    return cell, first, pieces


def marginals(emissions: np.ndarray, counts: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Probability of the toxic state for each token, rows of ``counts`` tokens each."""
    n = len(emissions)
    if n == 0:
        return np.zeros(0)
    cell, first, pieces = lay_out(counts)
    many = int(pieces.sum())
    x, real = np.ones(many * SEGMENT), np.zeros(many * SEGMENT, bool)
    x[cell], real[cell] = np.exp(emissions), True
    x, real = x.reshape(many, SEGMENT).T.copy(), real.reshape(many, SEGMENT).T.copy()
    (a00, a01), (a10, a11) = np.exp(moves)
    rows = np.flatnonzero(pieces)
    opening = np.zeros(many, bool)
    opening[first[rows]] = True

    def ahead(t: int, r: np.ndarray) -> np.ndarray:
        out = np.where(real[t], x[t] * (a01 + a11 * r) / (a00 + a10 * r), r)
        return np.where(opening, x[0], out) if t == 0 else out  # no move leads into a row's first token

    def back(t: int, s: np.ndarray) -> np.ndarray:
        y = x[t] * s
        return np.where(real[t], (a10 + a11 * y) / (a00 + a01 * y), s)

    # Transfer of a whole segment, as a fraction (p r + q) / (u r + v) of the ratio that comes in.
    def transfer(order: range, step) -> tuple[np.ndarray, ...]:
        p, q, u, v = np.ones(many), np.zeros(many), np.zeros(many), np.ones(many)
        for t in order:
            c = step(t)
            p, q, u, v = c[0] * p + c[1] * u, c[0] * q + c[1] * v, c[2] * p + c[3] * u, c[2] * q + c[3] * v
            scale = 1 / (p + q + u + v)
            p, q, u, v = p * scale, q * scale, u * scale, v * scale
        return p, q, u, v

    one, zero = np.ones(many), np.zeros(many)

    def ahead_step(t: int) -> tuple[np.ndarray, ...]:
        m = real[t]
        c = np.where(m, x[t] * a11, one), np.where(m, x[t] * a01, zero), np.where(m, a10, zero), np.where(m, a00, one)
        return tuple(np.where(opening, a, b) for a, b in zip((zero, x[0], zero, one), c, strict=True)) if t == 0 else c

    def back_step(t: int) -> tuple[np.ndarray, ...]:
        m = real[t]
        return np.where(m, a11 * x[t], one), np.where(m, a10, zero), np.where(m, a01 * x[t], zero), np.where(m, a00, one)

    into, after = np.ones(many), np.ones(many)
    long = rows[np.argsort(-pieces[rows], kind="stable")]
    lengths = pieces[long]
    if lengths[0] > 1:
        p, q, u, v = transfer(range(SEGMENT), ahead_step)
        b, c, d, e = transfer(range(SEGMENT - 1, -1, -1), back_step)
    for k in range(1, int(lengths[0])):
        at = first[long[: np.searchsorted(-lengths, -k, "left")]] + k - 1  # segments that another follows
        r = into[at]
        into[at + 1] = (p[at] * r + q[at]) / (u[at] * r + v[at])
        end = first[long[: len(at)]] + lengths[: len(at)] - k  # from the row's last segment back
        s = after[end]
        after[end - 1] = (b[end] * s + c[end]) / (d[end] * s + e[end])
    odds = np.empty((SEGMENT, many))
    r = into
    for t in range(SEGMENT):
        r = ahead(t, r)
        odds[t] = r
    s = after
    for t in range(SEGMENT - 1, -1, -1):
        odds[t] *= s
        s = back(t, s)
    out = odds.T.reshape(-1)[cell]
    return out / (1 + out)


def pair_marginals(p: np.ndarray, follows: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Probabilities of the states (clean and clean, clean and toxic, toxic and clean, both toxic) of each token that follows
    another and the one before it, from the two marginals: a pair's odds ratio is that of the move between them."""
    at = np.flatnonzero(follows)
    a, b = p[at - 1], p[at]
    ratio = np.exp(moves[0, 0] + moves[1, 1] - moves[0, 1] - moves[1, 0])
    if abs(ratio - 1) < 1e-9:
        both = a * b
    else:
        s = 1 + (a + b) * (ratio - 1)
        both = 2 * ratio * a * b / (s + np.sqrt(np.maximum(s * s - 4 * ratio * (ratio - 1) * a * b, 0)))
    return np.stack([1 - a - b + both, b - both, a - both, both])


def all_clean(p: np.ndarray, counts: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Log of the probability that all tokens of a row are clean; each token's row, which tokens follow another, and their pairs."""
    row = np.repeat(np.arange(len(counts)), counts)
    follows = np.ones(len(p), bool)
    follows[(np.cumsum(counts) - counts)[counts > 0]] = False
    pairs = pair_marginals(p, follows, moves)
    stays = np.log(np.maximum(1 - p, 1e-30))
    at = np.flatnonzero(follows)
    stays[at] = np.log(np.maximum(pairs[0], 1e-30)) - stays[at - 1]  # clean, given that the one before is
    return np.bincount(row, np.minimum(stays, 0), len(counts)), row, follows, pairs


def likelihood_of_label(clean: np.ndarray) -> np.ndarray:
    """Probability that a document is labelled toxic, from the log of the probability that all its tokens are clean."""
    return NOISE + (1 - 2 * NOISE) * -np.expm1(clean)


def train(texts: list[str], labels: list[int], epochs: int = 15, rate: float = 0.05, ridge: float = 3e-5, seed: int = 3) -> Field | None:
    """Fits the field on whole texts and their labels; None without a text with words in both classes."""
    data, offsets = utf8(pa.array(texts, pa.large_string()))
    parts = [tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])[2:] for i, j in slices(offsets)]
    counts = np.concatenate([c for c, _ in parts]) if parts else np.zeros(0, np.int64)
    toxic = np.array(labels, bool)
    if not toxic[counts > 0].any() or toxic[counts > 0].all():
        return None
    features = np.concatenate([f for _, f in parts])
    del parts, data
    begin = np.cumsum(counts) - counts
    rng = np.random.default_rng(seed)
    params = {"weights": np.zeros(1 << BITS), "bias": np.array([-6.0]), "moves": np.zeros((2, 2))}
    first, second = {k: np.zeros_like(v) for k, v in params.items()}, {k: np.zeros_like(v) for k, v in params.items()}
    field = Field(params["weights"], -6.0, params["moves"])
    steps = -(-int(counts.sum()) // STEP_TOKENS)
    step = 0
    for _ in range(max(epochs, -(-TRAIN_STEPS // steps))):
        order = rng.permutation(np.flatnonzero(counts))
        group = (np.cumsum(counts[order]) - 1) // STEP_TOKENS
        for part in np.split(order, np.flatnonzero(np.diff(group)) + 1):
            size = counts[part]
            f = features[np.arange(size.sum()) + np.repeat(begin[part] - (np.cumsum(size) - size), size)]
            field.bias = float(params["bias"][0])
            p = marginals(field.emissions(f), size, field.moves)
            clean, row, follows, pairs = all_clean(p, size, field.moves)
            label = likelihood_of_label(clean)
            # Slope of the documents' loss over the log of the probability that all is clean; that of a token's emission on it is minus its marginal.
            slope = (1 - 2 * NOISE) * np.exp(clean) * np.where(toxic[part], 1 / label, -1 / (1 - label))
            error, of_pair = -slope[row] * p, -slope[row[follows]]
            grad = {
                "weights": sum(np.bincount(f[:, k], error, 1 << BITS) for k in range(f.shape[1])) / len(part) + ridge * field.weights,
                "bias": np.array([error.sum() / len(part)]),
                "moves": np.array([((pairs[0] - 1) * of_pair).sum(), *((x * of_pair).sum() for x in pairs[1:])]).reshape(2, 2) / len(part) + ridge * field.moves,
            }
            step += 1
            for k, g in grad.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                params[k] -= rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    field.bias = float(params["bias"][0])
    return field


def tag(field: Field | None, column: pa.Array, least: float = 0.5) -> tuple[np.ndarray, list[list[dict]]]:
    """Score of each text, and its spans of tokens whose marginal is ``least`` or more, in code points with their largest marginal."""
    n = len(column)
    scores, spans = np.zeros(n), [[] for _ in range(n)]
    if field is None:
        return scores, spans
    data, offsets = utf8(column)
    for i, j in slices(offsets, 1 << 19):
        part, base = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, counts, features = tokens(part, base)
        p = marginals(field.emissions(features), counts, field.moves)
        clean, row, _, _ = all_clean(p, counts, field.moves)
        label = likelihood_of_label(clean)
        scores[i:j] = 1 / (1 + np.exp(field.shift) * (1 - label) / label)
        previous, chars = (-1, -1), None
        for k in np.flatnonzero(p >= least).tolist():
            r = int(row[k])
            if chars is None or chars[0] != r:
                own = part[base[r] : base[r + 1]]
                chars = r, np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])
            a, b = int(chars[1][starts[k] - base[r]]), int(chars[1][ends[k] - base[r]])
            if previous == (r, k - 1):
                spans[i + r][-1]["end"] = b
                spans[i + r][-1]["p"] = max(spans[i + r][-1]["p"], float(p[k]))
            else:
                spans[i + r].append({"start": a, "end": b, "p": float(p[k])})
            previous = r, k
    return scores, spans


def fit(docs: DataFrame, labels: DataFrame, where: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS) -> Field | None:
    """Trains on the whole texts of at most ``rows`` labelled documents of each class that hold ``where`` (on ``id_col``).

    They are those with the least hashes of their ids, the same in every run.
    Null ids, labels and texts are left out; an id with several labels is toxic
    if one says so, and of one with several texts the smallest is read.
    """
    pool = labels.where(where & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(id_col).alias("i"), (F.col(label_col) > 0).cast("int").alias("y")).groupBy("i").agg(F.max("y").alias("y"))
    sizes = dict(pool.groupBy("y").count().collect())
    if len(sizes) < 2:
        return None
    key = F.pmod(F.xxhash64(F.col("i").cast("string")), F.lit(1 << 30))

    def least(y: int) -> DataFrame:
        """About twice the wanted ids get through the filter, so that no task sends many to the final choice."""
        few = pool.where((F.col("y") == y) & (key < int((1 << 30) * min(1.0, 2 * rows / sizes[y]))))
        return few.orderBy(key, F.col("i").cast("string")).limit(rows)

    chosen = least(0).union(least(1))  # at most 2 * rows ids, which may be broadcast
    got = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t")).where(F.col("t").isNotNull()).join(F.broadcast(chosen), "i").groupBy("i", "y").agg(F.min("t").alias("t")).collect()
    got.sort(key=lambda r: str(r.i))
    field = train([r.t for r in got], [r.y for r in got])
    if field is not None:
        taken = [sum(r.y == y for r in got) for y in (0, 1)]
        field.shift = float(np.log(sizes[0] / sizes[1]) - np.log(taken[0] / taken[1]))
    release()
    return field


def tag_texts(df: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``score`` and ``spans`` (start, end, p) of each whole text, in a narrow pass.

    Null and empty texts have no token; their score is that of a label that is
    wrong. Without a model every score is 0. One row out for each row in.
    """
    bounded(df.sparkSession)
    shipped = df.sparkSession.sparkContext.broadcast(field)
    narrow = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores, spans = tag(shipped.value, b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores), pa.array(spans, kind)], ["id", "score", "spans"])

    schema = f"id {narrow.schema['id'].dataType.simpleString()}, score double, spans array<struct<start:int,end:int,p:double>>"
    return narrow.mapInArrow(trimmed(run), schema).toDF(id_col, "score", "spans")
