"""Video containers made here byte by byte, against the times they were made of."""

import random
import struct

import pytest

from kinetrace.sources import video


def box(kind, *parts):
    body = b"".join(parts)
    return struct.pack(">I4s", len(body) + 8, kind) + body


def wide_box(kind, body):
    """A box whose size has 64 bits."""
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


def u4(*values):
    return struct.pack(f">{len(values)}I", *values)


def track(number, kind, scale, steps, offsets=None, edits=None, size=(320, 240), codec=b"avc1"):
    entry = box(codec, bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HH", *size), bytes(50))
    tables = [box(b"stsd", u4(0, 1), entry), box(b"stts", u4(0, len(steps)), *[u4(*s) for s in steps]), box(b"stsz", u4(0, 0, 0))]
    if offsets is not None:
        tables.append(box(b"ctts", u4(1 << 24, len(offsets)), *[struct.pack(">Ii", *o) for o in offsets]))
    edts = [box(b"edts", box(b"elst", u4(0, len(edits)), *[struct.pack(">IiI", n, at, 1 << 16) for n, at in edits]))] if edits else []
    media = box(b"mdia", box(b"mdhd", u4(0, 0, 0, scale, 0, 0)), box(b"hdlr", u4(0, 0), kind, bytes(12)), box(b"minf", box(b"stbl", *tables)))
    return box(b"trak", box(b"tkhd", u4(7, 0, 0, number), bytes(68)), *edts, media)


def film(*tracks, extra=b"", after=b"", pictures=64):
    return box(b"ftyp", b"isom", bytes(4)) + wide_box(b"mdat", bytes(pictures)) + box(b"moov", box(b"mvhd", u4(0, 0, 0, 1000), bytes(84)), *tracks, extra) + after


def times(spark, folder, **where):
    runs = video.video_runs(spark, str(folder))
    for c, v in where.items():
        runs = runs.where(f"{c} = '{v}'")
    rows = video.frame_times(runs).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r.path, r.track_id, r.frame_idx)):
        out.setdefault((r.path.rsplit("/", 1)[1], r.track_id), []).append(round(r.pts_seconds, 6))
    return out


def test_runs_with_offsets_and_edits(spark, tmp_path):
    rng = random.Random(5)
    expected = {}
    for name in range(12):
        scale = rng.choice([90, 1000, 30000])
        steps = [(rng.randint(1, 40), rng.randint(0, 3000)) for _ in range(rng.randint(1, 30))]
        n = sum(k for k, _ in steps)
        offsets, left = [], n
        while left > 0:
            k = min(left, rng.randint(1, 5))
            offsets.append((k, rng.randint(-200, 900)))
            left -= k
        edits = rng.choice([None, [(0, 100)], [(500, -1), (0, 70)]])
        (tmp_path / f"f{name}.mp4").write_bytes(film(track(3, b"vide", scale, steps, offsets, edits), track(4, b"soun", 8, [(2, 4)])))
        at, plain = 0, []
        late = [v for k, v in offsets for _ in range(k)]
        for step in (v for k, v in steps for _ in range(k)):
            plain.append(at + late[len(plain)])
            at += step
        shift = 0.0 if edits is None else sum(length / 1000 for length, b in edits if b < 0) - edits[-1][1] / scale
        expected[f"f{name}.mp4", 3] = [round(u / scale + shift, 6) for u in sorted(plain)]
    got = times(spark, tmp_path, handler="vide")
    assert {k: [pytest.approx(x, abs=2e-6) for x in v] for k, v in expected.items()} == got
    assert len(times(spark, tmp_path)) == 24


def test_fragments_go_on(spark, tmp_path):
    trex = box(b"mvex", box(b"trex", u4(0, 1, 1, 20, 0, 0)))
    runs = box(b"traf", box(b"tfhd", u4(0, 1)), box(b"trun", u4(0, 3)), box(b"trun", u4(0x100 | 0x800, 3, 5, 0, 5, 4, 6, 4)))
    other = box(b"traf", box(b"tfhd", u4(8, 9, 7)), box(b"trun", u4(0, 50)))
    timed = box(b"traf", box(b"tfhd", u4(8, 1, 7)), box(b"tfdt", u4(1 << 24, 0, 1000)), box(b"trun", u4(0, 2)))
    (tmp_path / "a.mp4").write_bytes(film(track(1, b"vide", 10, [(2, 10)]), extra=trex, after=box(b"moof", other, runs) + box(b"mdat", bytes(9)) + box(b"moof", timed)))
    units = [0, 10, 20, 40, 60, 80, 89, 94, 1000, 1007]
    assert times(spark, tmp_path) == {("a.mp4", 1): [u / 10 for u in units]}


def test_predicates_are_pushed(spark, tmp_path):
    good, bad = track(1, b"vide", 10, [(3, 1)]), track(2, b"soun", 10, [(3, 1)])
    # The sound track's table claims more runs than it has: reading it would raise.
    broken = bad.replace(u4(0, 1, 3, 1), u4(0, 900, 3, 1))
    (tmp_path / "a.mp4").write_bytes(film(good, broken))
    assert times(spark, tmp_path, handler="vide") == {("a.mp4", 1): [0.0, 0.1, 0.2]}
    assert times(spark, tmp_path, codec="hvc1") == {}
    with pytest.raises(Exception, match="is too short"):
        times(spark, tmp_path)
    (tmp_path / "b.mp4").write_bytes(b"no film")
    one = video.video_runs(spark, str(tmp_path)).where(f"path = '{tmp_path}/a.mp4' and handler = 'vide'")
    assert one.count() == 1
    with pytest.raises(Exception, match="b.mp4"):
        video.video_runs(spark, str(tmp_path)).where("handler = 'vide'").count()


def test_probe_and_no_frames(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert video.video_runs(spark, str(tmp_path / "empty")).count() == 0
    (tmp_path / "a.mov").write_bytes(film(track(1, b"vide", 30000, [(2000000, 1001), (3, 500)], size=(1920, 1080)), track(2, b"vide", 10, [])))
    runs = video.video_runs(spark, str(tmp_path / "a.mov"))
    assert runs.count() == 2  # two million frames of constant rate are one row
    row = video.probe(runs).collect()
    assert [(r.track_id, r.width, r.height, r.codec, r.nb_frames) for r in row] == [(1, 1920, 1080, "avc1", 2000003)]
    assert row[0].duration_sec == pytest.approx(2002001500 / 30000) and row[0].fps_nominal == 60.0


@pytest.mark.parametrize("cut", [3, 40, 140, 300, 420])
def test_cut_files_raise(spark, tmp_path, cut):
    whole = film(track(1, b"vide", 10, [(3, 1)]))
    (tmp_path / "a.mp4").write_bytes(whole[: min(cut, len(whole) - 1)])
    with pytest.raises(Exception, match="DamagedVideo"):
        video.video_runs(spark, str(tmp_path)).count()


def test_pictures_are_not_read(tmp_path):
    """The bytes read do not grow with the pictures."""
    read = []
    for pictures in (10, 10_000_000):
        path = tmp_path / f"{pictures}.mp4"
        path.write_bytes(film(track(1, b"vide", 10, [(3, 1)]), pictures=pictures))

        class Counted:
            def __init__(self, file):
                self.file, self.total = file, 0

            def seek(self, at):
                self.file.seek(at)

            def read(self, n):
                data = self.file.read(n)
                self.total += len(data)
                return data

        with open(path, "rb") as f:
            counted = Counted(f)
            assert len(list(video.tracks(counted, path.stat().st_size, lambda facts: True))) == 1
            read.append(counted.total)
    assert read[0] == read[1]
