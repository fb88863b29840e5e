"""License scans and vector codes against plain versions, and their edge cases."""

import hashlib
import math
import random

import numpy as np
import pytest

from kinetrace.llm import licenses, partcodes, queries
from tests.compare import DATA, same
from tests.llm.brute import WORD_1, lower

SF = f"{DATA}/sf0.001"
KIND = "doc_id long, text string, score string, n_words long"


@pytest.mark.parametrize("name", ["op11_license_scan", "op12_vector_codes"])
def test_query_equals_its_sql(spark, name):
    assert same(spark, queries.QUERIES[name], queries.ORACLES[name], SF) > 0


# 11


def notices(texts, templates=licenses.TEMPLATES):
    """Matches of each text: every template laid over every place."""
    words = [WORD_1.findall(lower(t)) for t in texts]
    weight = {w: round(1000 * (math.log((len(texts) + 1) / (sum(w in own for own in words) + 1)) + 1)) for t in templates for w in t.words}
    out = []
    for own in words:
        found = []
        for k, t in enumerate(templates):
            total, n = sum(weight[w] for w in t.words), len(t.words)
            for s in range(-n + 1, len(own)):
                match = [0 <= s + j < len(own) and own[s + j] == w for j, w in enumerate(t.words)]
                got = sum(weight[w] for w, m in zip(t.words, match, strict=True) if m)
                if 100 * got >= t.least * total and all(match[j] for j in t.key_places()):
                    found.append((s, k, t.label, n, got / total))
        out.append([(label, s, n, share) for s, _, label, n, share in sorted(found)])
    return out


def check(spark, texts):
    rows = spark.createDataFrame([(k, t, "x", 5) for k, t in enumerate(texts)], KIND).repartition(3)
    got = {r.doc_id: r for r in licenses.scan(rows).collect()}
    for k, want in enumerate(notices(texts)):
        assert [(m.label, m.start, m.n_words, m.share) for m in got[k].matches] == want
        assert got[k].n_words == len(WORD_1.findall(lower(texts[k]))) and got[k].score == max([0, *[w[3] for w in want]])
    return got


def test_notices_equal_brute_force_on_documents(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = check(spark, texts)
    assert {"mit", "apache-2.0", "cc-by-nc"} <= {m.label for r in got.values() for m in r.matches}


def test_notices_that_are_changed_cut_off_or_repeated(spark):
    """Words at random from the licences' own vocabulary, and notices with a word lost."""
    rng = random.Random(5)
    words = licenses.vocabulary(licenses.TEMPLATES)
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(60)]
    for t in licenses.TEMPLATES:
        own = t.words
        texts += [t.text, f"before {t.text} after", " ".join(own[1:]), " ".join(own[:-1]), " ".join([*own[: len(own) // 2], "changed", *own[len(own) // 2 + 1 :]]), f"{t.text} {t.text}".upper()]
    check(spark, texts)


def test_license_edge_cases(spark):
    texts = [None, "", "  \n", "!!", "cc-by", "CC BY cc by", "cc by" * 2, "all rights reserved", "all  RIGHTS, reserved.", "cc" * 300_000 + " cc by", "é cc by 𝒳", "cc by " * 30_000]
    got = check(spark, texts)
    assert [(m.label, m.start) for m in got[5].matches] == [("cc-by", 0), ("cc-by", 2)] and len(got[11].matches) == 30_000
    rows = spark.createDataFrame([(None, "cc by", "x", 5), (1, "cc by", None, None), (1, "cc by", None, None)], KIND)
    assert sorted((r.doc_id or 0, len(r.matches)) for r in licenses.scan(rows).collect()) == [(0, 1), (1, 1), (1, 1)]
    assert licenses.scan(rows.where("false")).collect() == []


def test_only_rare_words_are_looked_up():
    """A common word proposes nothing, and the weights left out could not reach the least share."""
    words = licenses.vocabulary(licenses.TEMPLATES)
    counts = {w: 900 if w in ("the", "of", "to", "and", "license") else 3 for w in words}
    index = licenses.Index(licenses.TEMPLATES, words, licenses.weights(1000, counts, words))
    for t, own, weight, lookups in zip(licenses.TEMPLATES, index.words, index.weight, index.postings, strict=True):
        left = sum(int(w) for j, w in enumerate(weight) if j not in {j for _, j in lookups})
        assert 100 * left < t.least * int(weight.sum()) and len(lookups) <= max(1, len(own) // 2)
    assert all(words[w] not in ("the", "of", "to", "and", "license") for lookups in index.postings for w, _ in lookups)


# 12


def codes(rows, parts=16, entries=64, rounds=2):
    """{row: (code, error)} and the codebooks, by plain loops over Python's whole numbers."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept_rows = [k for k, (_, v, _) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v in first] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for _, v in kept:
                own.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(x[d] for x in own[e]) // len(own[e]) for d in range(width)] if e in own else c for e, c in enumerate(books[p])]
    out = {}
    for k, (_, v) in zip(kept_rows, kept, strict=True):
        met = [near(cut(v, p), books[p]) for p in range(parts)]
        out[k] = ("".join(f"{e:02x}" for _, e in met), sum(d for d, _ in met))
    return out, hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()


def compared(spark, rows, kind="vec_id long, embedding array<double>, label string, error string"):
    want, digest = codes(rows)
    total = {}
    for k, (_, error) in want.items():
        total[rows[k][2]] = total.get(rows[k][2], 0) + error
    wanted = sorted((str(rows[k][0]), code, error, total[rows[k][2]], digest) for k, (code, error) in want.items())
    got = partcodes.compress(spark.createDataFrame([(*r, "x") for r in rows], kind).repartition(3))
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in got.collect()) == wanted
    return got


def test_codes_equal_plain_loops(spark):
    rng = random.Random(3)
    rows = [(k, [rng.gauss(0, 0.3) for _ in range(32)], rng.choice(["a", "a", "a", "b", None])) for k in range(200)]
    rows += [(1000, None, "a"), (1001, [None] + [0.0] * 31, "a"), (1002, [float("nan")] + [0.0] * 31, "b"), (1003, [float("-inf")] + [0.0] * 31, None), (None, [0.25] * 32, "c"), (7, rows[7][1], "b"), (7, [-0.001] * 32, "b")]
    compared(spark, rows)


def test_codes_of_few_and_tied_vectors(spark):
    compared(spark, [(k, [float(k % 2)] * 16, None) for k in range(5)])
    compared(spark, [(k, [-0.5, 0.5] * 8, "x") for k in range(300)])


def test_codes_with_many_labels(spark):
    rng = random.Random(4)
    compared(spark, [(k, [rng.random() for _ in range(16)], None if k % 3 == 0 else f"{k % 500}") for k in range(900)])


def test_no_vectors_give_no_codes(spark):
    kind = "vec_id long, embedding array<float>, label int, code string"
    assert partcodes.compress(spark.createDataFrame([], kind)).collect() == []
    out = partcodes.compress(spark.createDataFrame([(1, None, 3, "x")], kind))
    assert out.collect() == [] and out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


@pytest.mark.parametrize("rows", [[(1, [0.0] * 16), (2, [0.0] * 32)], [(1, [0.0] * 15)], [(1, [1e30] * 16)]])
def test_vectors_that_cannot_be_coded_raise(spark, rows):
    with pytest.raises(Exception, match="vectors|component"):
        partcodes.compress(spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int")).collect()


def test_blocks_and_tree_do_not_change_the_books(spark, tmp_path):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(k, rng.normal(size=32).tolist()) for k in range(700)], "vec_id long, embedding array<double>")
    digests = {partcodes.books_digest(partcodes.fit(df.repartition(n), f"file://{tmp_path}/{n}")) for n in (1, 7, 40)}
    assert len(digests) == 1


def test_decoded_vectors_are_the_entries(spark, tmp_path):
    df = spark.createDataFrame([(k, [k / 256.0] * 16) for k in range(64)], "vec_id long, embedding array<double>")
    books = partcodes.fit(df, f"file://{tmp_path}/b")
    out = partcodes.decode(partcodes.encode(df, books), books).collect()
    assert all(r.error == 0 and r.vector == [r.vec_id / 256.0] * 16 for r in out)
