"""The pipeline's stages against plain versions, on the smallest tables."""

import re

import corpus_pipeline
from kinetrace.llm import queries
from tests.compare import DATA
from tests.llm import brute

SF = f"{DATA}/sf0.001"


def test_stages_equal_brute_force(spark, tmp_path):
    import sentencepiece

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append({r.doc_id: r for r in docs.collect()})
        if k < len(corpus_pipeline.STAGES) - 1:
            assert sorted(docs.columns) == sorted(corpus_pipeline.COLUMNS)
    named, unique, clean, quiet, tokens = kept
    raw = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(named) == {i for i, t in raw.items() if re.search(r"[^\W\d_]", t or "")}
    groups = brute.groups([(i, r.text) for i, r in named.items()], 5)
    assert set(unique) == {i for i, g in groups.items() if g[2]} and len(unique) < len(named)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    cut = 0
    for i, r in unique.items():
        _, hit, _ = brute.leaks(r.text, items)
        if not any(hit):
            assert clean[i].text == r.text
        elif all(hit):
            assert i not in clean
        else:
            cut += 1
            assert clean[i].n_chars == len(clean[i].text) < len(r.text)
    assert cut
    for i, r in clean.items():
        out, at = "", 0
        for a, _, b in brute.secrets(r.text):
            if a >= at:
                out += r.text[at:a] + "[secret]"
            at = max(at, b)
        assert re.sub(r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "[secret]", out + r.text[at:]) == quiet[i].text
    library = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path())
    assert {i: r.ids for i, r in tokens.items()} == {i: library.encode(r.text) for i, r in quiet.items()}


def test_odd_rows_and_empty_tables(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "the cat and the dog", "en", "s", 3), (1, "the cat and the dog", "en", "s", 3), (2, "", None, None, None), (None, "password=abcdefgh and more words", "en", None, None)]
    for df in (spark.createDataFrame(rows, kind), spark.createDataFrame([], kind)):
        n = df.count()
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, SF)
        assert df.count() == (2 if n else 0)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens").count() > 0


def test_a_run_that_broke_off_goes_on(spark, tmp_path, monkeypatch):
    """And a ledger that outlives it: the second run scans nothing again."""
    folder, ledger = f"file://{tmp_path}/run", f"file://{tmp_path}/ledger"
    whole = sorted(map(str, corpus_pipeline.run(spark, SF, folder, ledger).collect()))
    called = []
    watched = [(n, lambda *a, f=f, n=n, **k: called.append(n) or f(*a, **k)) for n, f in corpus_pipeline.STAGES]
    monkeypatch.setattr(corpus_pipeline, "STAGES", watched)
    (tmp_path / "run" / "stage2" / "_SUCCESS").unlink()
    (tmp_path / "run" / "stage3" / "_SUCCESS").unlink()
    assert sorted(map(str, corpus_pipeline.run(spark, SF, folder).collect())) == whole
    assert called == [n for n, _ in watched[2:]]
    monkeypatch.undo()
    seen = spark.read.parquet(f"{ledger}/seen").count()
    corpus_pipeline.secret_scan(spark, spark.read.parquet(f"{folder}/stage2"), SF, ledger)
    assert spark.read.parquet(f"{ledger}/seen").count() == seen


def test_near_dedup_of_ids_with_several_texts(spark):
    """Only the linked or exactly repeated text of an id goes, and an id's texts do not link others."""
    a, b, c, d = (" ".join(f"{w}{k}" for k in range(60)) for w in ("sun", "moon", "star", "rain"))
    rows = [(-3, d), (1, a), (5, a + " end"), (5, b), (7, c), (7, c), (7, ""), (9, b + " end"), (-2, d + " end"), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()]
    assert sorted(got, key=str) == sorted([(-3, d), (1, a), (5, b), (7, c), (7, ""), (None, a)], key=str)


def test_near_dedup_takes_ids_that_are_texts(spark):
    """Also where an id has several texts: a document is an id and a text."""
    long = " ".join(f"w{k}" for k in range(60))
    rows = [("b", long), ("a", long + " more"), ("a", "another text of its own that is long enough"), (None, long), ("c", "short"), ("c", "short")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id string, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_dedup(spark, docs, "unused").collect()
    assert sorted((r.doc_id or "", r.text) for r in kept) == sorted([("", long), ("a", long + " more"), ("a", "another text of its own that is long enough"), ("c", "short")])
