import io
import json
import os
import zipfile

from pyspark.sql import functions as F

from kinetrace.schema import BODY_PARTS
from kinetrace.sources import events, sinks, tracking

HEADER = "track,frame_idx,instance.score," + ",".join(f"{p}.x,{p}.y,{p}.score" for p in BODY_PARTS)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_poses(spark, tmp_path):
    line = lambda track, frame, x: f"{track},{frame},0.9," + ",".join([f"{x},2.0,0.5"] * 6)
    path = write(tmp_path / "p.csv", "\n".join([HEADER, line("track_0", 0, 1.5), line("1", 0, "nan"), line("", 1, "")]))
    rows = {(r.frame_idx, r.track): r for r in tracking.poses(spark, path).collect()}
    assert set(rows) == {(0, 0), (0, 1), (1, None)}
    assert rows[0, 0].nose_x == 1.5 and rows[0, 1].nose_x is None and rows[1, None].nose_x is None
    old = write(tmp_path / "old.csv", "\n".join([HEADER.replace(".score", ".p").replace("instance.p", "instance.score"), line(0, 0, 1)]))
    assert tracking.poses(spark, old).first().nose_score == 0.5


def test_frame_times_and_events(spark, tmp_path):
    pts = tracking.frame_times(spark, write(tmp_path / "pts.csv", "frame_idx,pts_seconds\n0,0.0\n1,0.5\n2,N/A\n3,1.0\n"))
    log = write(tmp_path / "log.csv", "timestamp,what,until\n0.4,loom,0.9\n5,air,\n")
    sources = [{"type": "bonsai_csv", "path": log, "event_type_column": "what", "end_time_column": "until"}, {"type": "unknown", "path": "x"}]
    found = events.collect(spark, sources)
    done = {r.event_id: r for r in events.with_frames(found, pts).collect()}
    assert (done["bonsai_1"].frame_start, done["bonsai_1"].frame_end, done["bonsai_2"].frame_start, done["bonsai_2"].frame_end) == (1, 3, 3, None)
    assert events.collect(spark, []).count() == 0
    two = events.collect(spark, [{**sources[0], "session": {"day": d}} for d in ("D1", "D2")])
    assert sorted((r.day, r.event_id) for r in two.collect()) == [("D1", "bonsai_1"), ("D1", "bonsai_2"), ("D2", "bonsai_1"), ("D2", "bonsai_2")]
    out = str(tmp_path / "events")
    sinks.write_events(events.with_frames(found, pts), out)
    text = "".join(open(f"{out}/{f}").read() for f in sorted(os.listdir(out)) if f.startswith("part"))
    assert "0.400000" in text and "bonsai_2,air,5.000000,,3,," in text
    assert os.path.exists(f"{out}/_SUCCESS")


ZONES = {"regions": [{"floor": [[0, 0], [10, 0], [10, 20], [0, 20]]}, {"nest": [[-4, 16], [14, 16], [14, 21], [-4, 21]]}, {"loom": [[5, 3.012], 32]}], "metadata": {"angle": 0}}


def test_zone_files(spark, tmp_path):
    r = tracking.zones(spark, write(tmp_path / "z.json", json.dumps(ZONES, indent=1))).first()
    assert (r.floor_y3, r.nest_x1, r.loom_x, r.loom_y, r.loom_radius) == (20.0, -4.0, 5.0, 3.012, 32.0)
    old = tracking.zones(spark, write(tmp_path / "o.json", json.dumps({"corners": ZONES["regions"][0]["floor"], "confidence": 0.4}))).first()
    assert old.floor_x2 == 10.0 and old.nest_x1 is None and old.loom_radius is None


def test_metadata(spark, tmp_path):
    r = tracking.metadata(spark, write(tmp_path / "m.json", json.dumps({"width": 640, "fps_nominal": "30000/1001", "crop_offset": {"x": 3, "y": 4}}))).first()
    assert r.fps == 29.595 and abs(r.fps_nominal - 29.97) < 0.01 and r.crop_offset.x == 3.0


def test_samples(spark, tmp_path):
    for f in ("A+B/D1/raw_data/v.avi", "A+B/D1/raw_data/u.mp4", "C/D2/raw_data/w.mov", "C/D2/other/x.mp4"):
        write(tmp_path / f, "x")
    got = sorted((r.identity, r.day, r.video_stem) for r in tracking.samples(spark, str(tmp_path)).collect())
    assert got == [("A+B", "D1", "u"), ("C", "D2", "w")]


def book(sheets):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    out = io.BytesIO()

    def letters(c):
        return (chr(64 + c // 26) if c >= 26 else "") + chr(65 + c % 26)

    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook {ns}><sheets>" + "".join(f'<sheet name="{n}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<R>" + "".join(f'<Relationship Id="r{k}" Target="worksheets/s{k}.xml"/>' for k, _ in enumerate(sheets, 1)) + "</R>")
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>shared 218</t></si></sst>")
        for k, rows in enumerate(sheets.values(), 1):
            cells = []
            for r, row in enumerate(rows, 1):
                for c, v in row.items():
                    if v == "shared 218":
                        cells.append(f'<c r="{letters(c)}{r}" t="s"><v>0</v></c>')
                    elif isinstance(v, str):
                        cells.append(f'<c r="{letters(c)}{r}" t="inlineStr"><is><t>{v}</t></is></c>')
                    else:
                        cells.append(f'<c r="{letters(c)}{r}"><v>{v}</v></c>')
            z.writestr(f"xl/worksheets/s{k}.xml", f"<worksheet {ns}><sheetData><row>{''.join(cells)}</row></sheetData></worksheet>")
    return out.getvalue()


def test_scoring_sheets(spark, tmp_path):
    rows = [{0: "L1"}, {0: "217"}, {1: 1, 4: 9.0}, {0: "shared 218"}, {1: 1, 4: 10.5, 17: 2.0, 26: 5.0}, {1: 2, 4: 20.0, 17: 3.0}, {1: 2, 17: 4.0, 26: 1.0}, {0: "219"}, {1: 1, 17: 7.0}]
    path = tmp_path / "m.xlsx"
    path.write_bytes(book({"L1": rows, "L2": []}))
    table = events.sheets(spark, str(path))
    assert [(r.event_id, r.time_start) for r in events.sheet_events(table, "L1", ["218"]).orderBy("time_start").collect()] == [("loom_1", 10.5), ("loom_2", 20.0)]
    assert sorted(map(tuple, events.sheet_scores(table, "L1", "218").collect())) == [(1, 2.0, 5.0), (2, 4.0, 1.0)]
    assert events.sheet_events(table, "L1", ["999"]).count() == 0


def test_saved_zones_and_sampling(spark):
    c = "array<array<double>>"
    old = spark.createDataFrame([("a", [[1.0]]), ("b", [[2.0]])], f"video string, corners {c}")
    new = spark.createDataFrame([("b", [[3.0]])], f"video string, corners {c}")
    assert {r.video: r.corners for r in tracking.saved_zones(old, new).collect()} == {"a": [[1.0]], "b": [[3.0]]}
    assert tracking.sampled_frames(spark.range(100).withColumnRenamed("id", "frame_idx"), 50, 20).count() == 3


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("s", 0, 1.25, None), ("s", 1, 2.5, 3.0)], "session string, frame_idx long, `a b` double, c double")
    sinks.write_features(df, str(tmp_path / "f"), ["session"])
    back = spark.read.parquet(str(tmp_path / "f"))
    assert dict(back.dtypes)["a b"] == "float" and back.count() == 2
    assert sinks.with_sentinels(df, ["c"], 30.0).where("c = -30").count() == 1
    sinks.write_json(sinks.as_json(df, ["session"]), str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).count() == 2
    lists = spark.createDataFrame([("s", [1, 2, 3], [9])], "k string, a array<int>, b array<int>")
    assert [(r.position, r.a, r.b) for r in sinks.ragged(lists, ["k"]).orderBy("position").collect()] == [(0, 1, 9), (1, 2, None), (2, 3, None)]
    poses = spark.createDataFrame([("s", 1, 0, 1.0), ("s", 0, 1, 1.0), ("s", 0, 0, 1.0)], "session string, frame_idx long, track int, x double")
    sinks.write_poses(poses, str(tmp_path / "p"), ["session"])
    sinks.write_results(poses.withColumnRenamed("track", "animal"), str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3 and os.path.isdir(tmp_path / "r" / "animal=0")


def test_feature_scan(spark, tmp_path):
    path = write(tmp_path / "f.csv", ",a,b\n0,1.5,2\n1,2.5,3\n")
    assert tracking.features(spark, path).select("frame_idx", "a").orderBy("frame_idx").collect()[1].a == 2.5


def test_quote_option(spark, tmp_path):
    path = write(tmp_path / "q.csv", HEADER + "\n" + "|track_2|,3,0.9," + ",".join(["1,2,3"] * 6))
    assert tracking.poses(spark, path, quote="|").select(F.max("track")).first()[0] == 2


def test_files_of_frame_times_do_not_grow_with_tracks(spark):
    from kinetrace.plans import file_queries

    read = file_queries.frame_time_files(spark, "/root/testdata/sf0.01")
    found = read.withColumn("file", F.input_file_name()).agg(F.count_distinct("file").alias("files"), F.count_distinct("track").alias("tracks")).first()
    assert found.files <= file_queries.FOLDERS < found.tracks
