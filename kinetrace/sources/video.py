"""Frame times of video files, read from the boxes of the container without decoding a picture.

An MP4 or QuickTime file is a tree of boxes. A track's times are stored as runs:
so many frames in a row, so many units apart. The source ``video_runs`` walks the
boxes by ranged reads, passes over the pictures and the tables it does not need,
and gives one row for each run; :func:`frame_times` unrolls the runs with
Spark's own functions, so a constant-rate film of hours is one row until then.

Fragmented files (``moof`` boxes) are read too. A file that is cut, or that is
no such container, raises :class:`DamagedVideo` with its path and place.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from kinetrace.workers import reachable

RUNS = "path string, track_id bigint, handler string, codec string, width int, height int, timescale bigint, shift double, sample bigint, frames bigint, time bigint, delta bigint, offset bigint"
ENDINGS = (".mp4", ".m4v", ".mov")
#: Columns whose equality is tested before a track's tables are read.
PUSHED = ("path", "handler", "codec", "track_id")


class DamagedVideo(ValueError):
    pass


def boxes(file: BinaryIO, at: int, end: int) -> Iterator[tuple[str, int, int]]:
    """Kind, begin and end of the contents of each box between two places."""
    while at < end:
        file.seek(at)
        head = file.read(16)
        if len(head) < 8:
            raise DamagedVideo(f"the file ends within a box header at {at}")
        size, body = int.from_bytes(head[:4], "big"), at + 8
        if size == 1:
            size, body = int.from_bytes(head[8:16], "big"), at + 16
        stop = end if size == 0 else at + size
        if stop < body or stop > end:
            raise DamagedVideo(f"the box at {at} does not fit into what holds it")
        yield head[4:8].decode("latin-1"), body, stop
        at = stop


def _inside(file: BinaryIO, span: tuple[int, int]) -> dict[str, tuple[int, int]]:
    """The first box of each kind."""
    found: dict[str, tuple[int, int]] = {}
    for kind, a, b in boxes(file, *span):
        found.setdefault(kind, (a, b))
    return found


def _bytes(file: BinaryIO, span: tuple[int, int], least: int = 0) -> bytes:
    file.seek(span[0])
    data = file.read(span[1] - span[0])
    if len(data) < max(least, span[1] - span[0]):
        raise DamagedVideo(f"the box at {span[0]} is too short")
    return data


def _pairs(file: BinaryIO, span: tuple[int, int], signed: bool = False) -> np.ndarray:
    """Run lengths and values of a table of times or offsets."""
    data = _bytes(file, span, 8)
    n = int.from_bytes(data[4:8], "big")
    if len(data) < 8 + 8 * n:
        raise DamagedVideo(f"the table at {span[0]} is too short")
    pairs = np.frombuffer(data, ">u4", 2 * n, 8).astype(np.int64).reshape(n, 2)
    if signed:  # both versions are in use with negative offsets
        pairs[:, 1] = pairs[:, 1].astype(np.uint32).astype(np.int32)
    return pairs[pairs[:, 0] > 0]


def merged(deltas: np.ndarray, offsets: np.ndarray, first: int = 0) -> np.ndarray:
    """Runs in which both the step and the offset are constant: sample, frames, time, delta, offset.

    ``deltas`` and ``offsets`` are (run length, value); frames without an offset have 0.
    """
    d_end, o_end = np.cumsum(deltas[:, 0]), np.cumsum(offsets[:, 0])
    n = int(d_end[-1]) if len(d_end) else 0
    cuts = np.unique(np.concatenate([[0], d_end, o_end[o_end < n]]))
    start, frames = cuts[:-1], np.diff(cuts)
    at = np.searchsorted(d_end, start, "right")
    began = np.concatenate([[0], np.cumsum(deltas[:, 0] * deltas[:, 1])])[at]
    time = first + began + (start - (d_end - deltas[:, 0])[at]) * deltas[at, 1]
    padded = np.append(offsets[:, 1], 0)
    return np.stack([start, frames, time, deltas[at, 1], padded[np.searchsorted(o_end, start, "right")]], 1)


def _long(data: bytes, at: int, wide: bool) -> int:
    return int.from_bytes(data[at : at + (8 if wide else 4)], "big")


def _shift(file: BinaryIO, span: tuple[int, int], movie_scale: int, scale: int) -> float:
    """Seconds to add to a track's times: empty edits delay it, the first real one drops what comes before."""
    data = _bytes(file, span, 8)
    wide, n, delay = data[0] == 1, int.from_bytes(data[4:8], "big"), 0.0
    size = 20 if wide else 12
    if len(data) < 8 + size * n:
        raise DamagedVideo(f"the edits at {span[0]} are too short")
    for k in range(n):
        length, begin = struct.unpack_from(">Qq" if wide else ">Ii", data, 8 + size * k)
        if begin >= 0:
            return delay - begin / scale
        delay += length / movie_scale
    return delay


def _fragments(file: BinaryIO, moofs: list[tuple[int, int]], track: int, usual: int, sample: int, time: int) -> Iterator[np.ndarray]:
    """Runs of a track's fragments, which go on from where the movie box ends."""
    for moof in moofs:
        for kind, a, b in boxes(file, *moof):
            if kind != "traf":
                continue
            within = list(boxes(file, a, b))
            head = _bytes(file, next(((x, y) for k, x, y in within if k == "tfhd"), (a, a)), 8)
            if int.from_bytes(head[4:8], "big") != track:
                continue
            flags, skip, step = int.from_bytes(head[1:4], "big"), 8, usual
            skip += (8 if flags & 1 else 0) + (4 if flags & 2 else 0)
            if flags & 8:
                step = _long(head, skip, False)
            for _, x, y in (w for w in within if w[0] == "tfdt"):
                said = _bytes(file, (x, y), 8)
                time = _long(said, 4, said[0] == 1)
            for _, x, y in (w for w in within if w[0] == "trun"):
                data = _bytes(file, (x, y), 8)
                flags, n = int.from_bytes(data[1:4], "big"), int.from_bytes(data[4:8], "big")
                fields = [bit for bit in (0x100, 0x200, 0x400, 0x800) if flags & bit]
                skip = 8 + (4 if flags & 1 else 0) + (4 if flags & 4 else 0)
                if len(data) < skip + 4 * n * len(fields):
                    raise DamagedVideo(f"the run at {x} is too short")
                rows = np.frombuffer(data, ">u4", n * len(fields), skip).reshape(n, len(fields))
                of = lambda bit, other: rows[:, fields.index(bit)].astype(np.int64) if bit in fields else np.full(n, other, np.int64)  # noqa: E731, B023
                steps, offsets = of(0x100, step), of(0x800, 0).astype(np.uint32).astype(np.int32).astype(np.int64)
                # Frames alike in step and offset are one run.
                edge = np.flatnonzero((np.diff(steps) != 0) | (np.diff(offsets) != 0)) + 1
                lengths = np.diff(np.concatenate([[0], edge, [n]]))
                first = np.concatenate([[0], edge])[: len(lengths)].astype(int)
                if n:
                    made = merged(np.stack([lengths, steps[first]], 1), np.stack([lengths, offsets[first]], 1), time)
                    made[:, 0] += sample
                    yield made
                    sample, time = sample + n, time + int(steps.sum())


def tracks(file: BinaryIO, size: int, wanted) -> Iterator[tuple[dict, np.ndarray]]:
    """Each wanted track's facts and runs; ``wanted`` sees the facts before any table is read."""
    movie, moofs = None, []
    for kind, a, b in boxes(file, 0, size):
        if kind == "moov":
            movie = (a, b)
        elif kind == "moof":
            moofs.append((a, b))
    if movie is None:
        raise DamagedVideo("the file has no movie box")
    found = list(boxes(file, *movie))
    scale_of = lambda data: _long(data, 20 if data[0] == 1 else 12, False)
    movie_scale = next((scale_of(_bytes(file, (a, b), 24)) for k, a, b in found if k == "mvhd"), 0) or 1
    usual = {}
    for _, a, b in (f for f in found if f[0] == "mvex"):
        for _, x, y in (f for f in boxes(file, a, b) if f[0] == "trex"):
            data = _bytes(file, (x, y), 24)
            usual[_long(data, 4, False)] = _long(data, 12, False)
    for _, a, b in (f for f in found if f[0] == "trak"):
        trak = _inside(file, (a, b))
        try:
            mdia = _inside(file, trak["mdia"])
            stbl = _inside(file, _inside(file, mdia["minf"])["stbl"])
            head, kind = _bytes(file, trak["tkhd"], 20), _bytes(file, mdia["hdlr"], 12)[8:12].decode("latin-1")
            scale, entry = scale_of(_bytes(file, mdia["mdhd"], 20)), _bytes(file, stbl["stsd"], 8)
        except KeyError as e:
            raise DamagedVideo(f"the track at {a} has no box {e.args[0]}") from None
        if scale == 0:
            raise DamagedVideo(f"the track at {a} has no time scale")
        seen = kind == "vide" and len(entry) >= 44
        facts = {
            "track_id": _long(head, 20 if head[0] == 1 else 12, False), "handler": kind, "codec": entry[12:16].decode("latin-1") if len(entry) >= 16 else None,
            "width": int.from_bytes(entry[40:42], "big") if seen else None, "height": int.from_bytes(entry[42:44], "big") if seen else None, "timescale": scale,
        }
        if not wanted(facts):
            continue
        edits = _inside(file, trak["edts"]).get("elst") if "edts" in trak else None
        facts["shift"] = _shift(file, edits, movie_scale, scale) if edits else 0.0
        none = np.zeros((0, 2), np.int64)
        runs = merged(_pairs(file, stbl["stts"]) if "stts" in stbl else none, _pairs(file, stbl["ctts"], True) if "ctts" in stbl else none)
        after = (int(runs[-1, 0] + runs[-1, 1]), int(runs[-1, 2] + runs[-1, 1] * runs[-1, 3])) if len(runs) else (0, 0)
        yield facts, np.concatenate([runs, *_fragments(file, moofs, facts["track_id"], usual.get(facts["track_id"], 0), *after)])


def _located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class _Files(InputPartition):
    files: list

    def __init__(self, files: list):
        super().__init__(None)
        self.files = files


class VideoReader(DataSourceReader):
    def __init__(self, path: str, files_per_task: int):
        self.path, self.files_per_task, self.tests = path, files_per_task, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute in [(c,) for c in PUSHED]:
                self.tests.append((f.attribute[0], [f.value] if isinstance(f, EqualTo) else list(f.value)))
            else:
                yield f

    def _fits(self, facts: dict) -> bool:
        return all(facts[c] in values for c, values in self.tests if c in facts)

    def partitions(self) -> list[InputPartition]:
        system, path = _located(self.path)
        info = system.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path, recursive=True))
        films = sorted((i.path, i.size) for i in found if i.type == fs.FileType.File and i.path.lower().endswith(ENDINGS) and self._fits({"path": i.path}))
        return [_Files(films[k : k + self.files_per_task]) for k in range(0, len(films), self.files_per_task)] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        system, _ = _located(self.path)
        for path, size in partition.files:
            with system.open_input_file(path) as file:
                try:
                    for facts, runs in tracks(file, size, self._fits):
                        yield _batch(path, facts, runs)
                except DamagedVideo as e:
                    raise DamagedVideo(f"{path}: {e}") from e


_ARROW = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}[k]) for n, k in (c.split() for c in RUNS.split(", "))])


def _batch(path: str, facts: dict, runs: np.ndarray) -> pa.RecordBatch:
    same = [pa.repeat(pa.scalar({"path": path, **facts}[f.name], f.type), len(runs)) for f in list(_ARROW)[:8]]
    return pa.RecordBatch.from_arrays([*same, *[pa.array(np.ascontiguousarray(runs[:, k]), pa.int64()) for k in range(5)]], schema=_ARROW)


class VideoSource(DataSource):
    """``spark.read.format("video_runs").load(folder)``; option ``files_per_task`` (32)."""

    @classmethod
    def name(cls) -> str:
        return "video_runs"

    def schema(self) -> str:
        return RUNS

    def reader(self, schema) -> VideoReader:
        return VideoReader(self.options["path"], int(self.options.get("files_per_task", 32)))


def register(spark: SparkSession) -> None:
    """Makes the source known to the session, and lets Python sources take predicates (a setting of the session)."""
    reachable(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(VideoSource)


def video_runs(spark: SparkSession, path: str, files_per_task: int = 32) -> DataFrame:
    """Runs of frames of all tracks of the video files at ``path`` (a file or a folder).

    An empty folder, and a track without frames, give no rows.
    """
    register(spark)
    return spark.read.format("video_runs").option("files_per_task", files_per_task).load(path)


def frame_times(runs: DataFrame) -> DataFrame:
    """path, track_id, frame_idx (from 0, in the order shown) and pts_seconds of each frame.

    Frames shown at the same time keep the order in which they are stored.
    """
    at = runs.select("path", "track_id", "timescale", "shift", "sample", "time", "delta", "offset", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("frames") - 1)).alias("k"))
    units = F.col("time") + F.col("k") * F.col("delta") + F.col("offset")
    timed = at.select("path", "track_id", units.alias("_units"), (F.col("sample") + F.col("k")).alias("_sample"), (units / F.col("timescale") + F.col("shift")).alias("pts_seconds"))
    order = Window.partitionBy("path", "track_id").orderBy("_units", "_sample")
    return timed.select("path", "track_id", (F.row_number().over(order) - 1).cast("bigint").alias("frame_idx"), "pts_seconds")


def probe(runs: DataFrame) -> DataFrame:
    """A row for each track: codec, width, height, frames, seconds, and the highest rate between two frames.

    The runs suffice; no frame is unrolled. The rate is null where all frames are at one time.
    """
    step = F.min(F.when(F.col("delta") > 0, F.col("delta")))
    facts = [F.first(c).alias(c) for c in ("handler", "codec", "width", "height")]
    length = F.sum(F.col("frames") * F.col("delta")) / F.first("timescale")
    return runs.groupBy("path", "track_id").agg(*facts, F.sum("frames").alias("nb_frames"), length.alias("duration_sec"), (F.first("timescale") / step).alias("fps_nominal"))


def write_files(df: DataFrame, folder: str, name: str, content: str) -> None:
    """Writes each row's bytes as a file below ``folder`` by its name, which may hold folders; a task that runs again writes the same files."""
    reachable(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _located(folder)
        for batch in batches:
            for n, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                system.create_dir(f"{base}/{n}".rpartition("/")[0], recursive=True)
                with system.open_output_stream(f"{base}/{n}", compression=None) as out:
                    out.write(data.as_buffer())
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["name"])

    df.select(F.col(name).alias("name"), F.col(content).cast("binary").alias("content")).mapInArrow(run, "name string").count()
