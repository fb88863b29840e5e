"""The jobs: whole tables against SQL, growing input, runs that broke off, and the command line."""

import glob
import json
import os
import re
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from jobs import registered, session_analysis, session_notes
from tests.compare import DATA, rows_of, same

SF = f"{DATA}/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("name", sorted(registered.ORACLES))
def test_job_equals_its_sql(spark, name):
    assert same(spark, registered.QUERIES[name], registered.ORACLES[name], SF) > 0


def rows(df):
    return rows_of(df.columns, df.collect())


def plain_bouts(notes, block=1000):
    """Bouts by a plain loop over each session's turns in order."""
    out = []
    for s in {n[0] for n in notes} - {None}:
        own = sorted({n for n in notes if n[0] == s and n[1] is not None}, key=lambda n: (n[1], n[2] or "", n[3] or ""))
        found = []
        for n in own:
            words = [w for w in re.split(r"[\t\n\r ]+", n[3] or "") if w]
            if not found or found[-1][0][2] != n[2]:
                found.append([])
            found[-1].append((*n[:3], len(n[3] or ""), len(words)))
        before = None
        for k, b in enumerate(found):
            turns = [t[1] for t in b]
            out.append((s, k, b[0][2], min(turns), max(turns), len(b), max(turns) - min(turns) + 1 - len(set(turns)), sum(t[3] for t in b), sum(t[4] for t in b), max(t[4] for t in b), None if before is None else min(turns) - before - 1, s // block))
            before = max(turns)
    return out


FIRST = [(1, 0, "a", "one two"), (1, 1, "b", None), (1, 2, "b", " x\ty\n"), (1, 5, "b", "z"), (2, 0, None, "q"), (2, 1, "a", "é 𝒳"), (None, 1, "a", "lost"), (3, None, "a", "lost"), (-4, 0, "a", "w " * 5000)]
SECOND = [(1, 3, "a", "late"), (1, 5, "b", "z"), (2500, 0, "a", ""), (2500, 9, "b", "v"), (2, 2, "a", "go on")]


def put(spark, folder, name, data):
    spark.createDataFrame(data, session_notes.NOTES).coalesce(1).write.parquet(f"{folder}/_{name}")
    os.makedirs(f"{folder}/in", exist_ok=True)
    shutil.move(glob.glob(f"{folder}/_{name}/part-*.parquet")[0], f"{folder}/in/{name}.parquet")


def bouts(spark, folder):
    columns = [c.split()[0] for c in session_notes.BOUTS.split(", ")]
    return rows(session_notes.result(spark, f"{folder}/out").select(*columns))


def wanted(data):
    return rows_of([c.split()[0] for c in session_notes.BOUTS.split(", ")], plain_bouts(data))


def notes(spark, folder):
    return session_notes.run(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint")


def test_notes_that_arrive_over_time(spark, tmp_path):
    """Each run reads new files alone; late and repeated turns take their place; a run without new files changes nothing."""
    put(spark, tmp_path, "a", FIRST)
    assert notes(spark, tmp_path)["read"] == len(FIRST) and bouts(spark, tmp_path) == wanted(FIRST)
    untouched = glob.glob(f"{tmp_path}/out/bouts/block=-1/*.parquet")
    put(spark, tmp_path, "b", SECOND)
    told = notes(spark, tmp_path)
    assert (told["read"], told["blocks"]) == (len(SECOND), 2) and bouts(spark, tmp_path) == wanted(FIRST + SECOND)
    assert glob.glob(f"{tmp_path}/out/bouts/block=-1/*.parquet") == untouched
    files = sorted(glob.glob(f"{tmp_path}/out/**/*.parquet", recursive=True))
    assert notes(spark, tmp_path)["batches"] == 0 and sorted(glob.glob(f"{tmp_path}/out/**/*.parquet", recursive=True)) == files


def test_a_batch_that_broke_off_is_taken_again(spark, tmp_path):
    put(spark, tmp_path, "a", FIRST)
    notes(spark, tmp_path)
    put(spark, tmp_path, "b", SECOND)
    notes(spark, tmp_path)
    for f in (f"{tmp_path}/checkpoint/commits/1", f"{tmp_path}/checkpoint/commits/.1.crc"):
        os.remove(f)  # as if the run had ended before it said that the batch was done
    assert notes(spark, tmp_path)["read"] == len(SECOND) and bouts(spark, tmp_path) == wanted(FIRST + SECOND)


def test_no_notes_yet(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in")
    assert notes(spark, tmp_path)["batches"] == 0 and bouts(spark, tmp_path) == []
    put(spark, tmp_path, "a", [(None, None, None, None)])
    assert notes(spark, tmp_path)["unplaced"] == 1 and bouts(spark, tmp_path) == []


def test_only_changed_sessions_are_analysed(spark, tmp_path):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").where("label < 3")
    source, output = f"{tmp_path}/in", f"{tmp_path}/out"
    vectors.where("label < 2").write.parquet(source)
    assert session_analysis.run(spark, source, output) == {"sessions": 2, "changed": 2, "gone": 0}
    first = {s: glob.glob(f"{output}/metrics/session={s}/*.parquet") for s in (0, 1)}
    assert session_analysis.run(spark, source, output) == {"sessions": 2, "changed": 0, "gone": 0}
    # A new session, one whose last row is lost, and one that only lies in other files.
    last = vectors.where("label = 1").agg(F.max("vec_id")).first()[0]
    vectors.where(F.col("vec_id") != last).repartition(3).write.mode("overwrite").parquet(source)
    assert session_analysis.run(spark, source, output) == {"sessions": 3, "changed": 2, "gone": 0}
    assert glob.glob(f"{output}/metrics/session=0/*.parquet") == first[0] and glob.glob(f"{output}/metrics/session=1/*.parquet") != first[1]
    session_analysis.run(spark, source, f"{tmp_path}/fresh")
    assert rows(session_analysis.result(spark, output)) == rows(session_analysis.result(spark, f"{tmp_path}/fresh"))
    vectors.where("label = 2").write.mode("overwrite").parquet(source)
    assert session_analysis.run(spark, source, output) == {"sessions": 1, "changed": 0, "gone": 2}
    assert {r.session for r in session_analysis.result(spark, output).collect()} == {2}
    assert session_analysis.run(spark, source, output) == {"sessions": 1, "changed": 0, "gone": 0}


def test_command_line(spark, tmp_path):
    put(spark, tmp_path, "a", FIRST)
    config = {"input": "nowhere", "output": f"{tmp_path}/out", "checkpoint": f"{tmp_path}/checkpoint", "sessions_per_block": 1000}
    with open(f"{tmp_path}/c.json", "w") as f:
        json.dump(config, f)
    done = subprocess.run([sys.executable, "-m", "jobs.session_notes", "--config", f"{tmp_path}/c.json", "--input", f"{tmp_path}/in"], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert re.search(r"read 9 turns .*, 2 without a place; wrote \d+ bouts of 2 blocks", done.stderr)
    assert bouts(spark, tmp_path) == wanted(FIRST)
    assert subprocess.run([sys.executable, "-m", "jobs.session_notes"], cwd=ROOT, capture_output=True, timeout=300).returncode == 2


def test_jobs_use_nothing_of_the_training_data_subpackage():
    for f in glob.glob(f"{ROOT}/jobs/*.py"):
        with open(f) as text:
            assert "llm" not in text.read() and "corpus_pipeline" not in f
