"""Event sources: logs, scoring sheets, and the registry that reads them by name."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Callable, Iterator, Sequence
from io import BytesIO
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinetrace.operators.align import nearest
from kinetrace.workers import reachable

_EVENT = "event_id string, event_type string, time_start double, time_end double"


def workbook(data: bytes) -> Iterator[tuple[str, int, int, str]]:
    """Cells of a workbook as (sheet, row from 0, column from 0, text); only the standard library is used."""
    space = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    link = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
    with zipfile.ZipFile(BytesIO(data)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in s.iter(f"{{{space['m']}}}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", space)]
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).findall("m:sheets/m:sheet", space):
            target = links[sheet.get(link)].lstrip("/")
            root = ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
            for c in root.iter(f"{{{space['m']}}}c"):
                m = re.fullmatch(r"([A-Z]+)(\d+)", c.get("r", ""))
                value = c.find("m:v", space)
                inline = "".join(t.text or "" for t in c.iter(f"{{{space['m']}}}t"))
                text = inline if value is None else value.text or ""
                if c.get("t") == "s" and value is not None:
                    text = shared[int(text)]
                if m and text != "":
                    column = 0
                    for letter in m[1]:
                        column = column * 26 + ord(letter) - 64
                    yield sheet.get("name"), int(m[2]) - 1, column - 1, text


def sheets(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows of all sheets: source, sheet, row, cells (map of column to text); a file is read in one task."""
    reachable(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for source, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows: dict[tuple[str, int], list] = {}
                for sheet, row, column, text in workbook(content):
                    rows.setdefault((sheet, row), []).append((column, text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([source] * len(rows)), pa.array([k[0] for k in rows], pa.string()), pa.array([k[1] for k in rows], pa.int32()), pa.array(list(rows.values()), pa.map_(pa.int32(), pa.string()))], ["source", "sheet", "row", "cells"]
                )

    return files.mapInArrow(run, "source string, sheet string, row int, cells map<int, string>")


def _number(cell: int):
    return F.try_element_at("cells", F.lit(cell)).try_cast("double")


def sheet_events(rows: DataFrame, sheet: str, animals: Sequence[str], most: int = 6, keys: Sequence[str] = ()) -> DataFrame:
    """Looms of a session's sheet: times above 0 in the ``most`` rows after the first that names an animal.

    The first row of a sheet is its header. A row without a number ends the
    list; a blank counts as 0. Each file (``source``) is taken by itself; name
    it in ``keys`` to keep it.
    """
    named = F.lit(False)
    for a in animals:
        named = named | F.contains(F.coalesce(F.try_element_at("cells", F.lit(0)), F.lit("")), F.lit(str(a)))
    body = rows.where((F.col("sheet") == sheet) & (F.col("row") > 0))
    time = F.when(F.try_element_at("cells", F.lit(4)).isNull(), F.lit(0.0)).otherwise(_number(4))
    whole, order = Window.partitionBy("source"), Window.partitionBy("source").orderBy("row")
    near = body.withColumns({"_first": F.min(F.when(named, F.col("row"))).over(whole), "_t": time}).where((F.col("row") > F.col("_first")) & (F.col("row") <= F.col("_first") + most))
    near = near.withColumn("_ended", F.max(F.col("_t").isNull().cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))).where("_ended = 0 and _t > 0")
    return near.select(*keys, F.concat(F.lit("loom_"), F.row_number().over(order)).alias("event_id"), F.lit("loom").alias("event_type"), F.col("_t").alias("time_start"), F.lit(None).cast("double").alias("time_end"))


def sheet_scores(rows: DataFrame, sheet: str, animal: str, keys: Sequence[str] = ()) -> DataFrame:
    """Manual latency and time in nest of an animal's section: loom, latency, time_in_nest, for each value of ``keys`` (such as ``source``).

    A section begins where column 0 has a text that names the animal and ends
    at the next text that does not; the last row of a loom holds.
    """
    order = Window.partitionBy("source").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    head = F.try_element_at("cells", F.lit(0))
    marked = rows.where(F.col("sheet") == sheet).withColumn("_section", F.last(head, True).over(order))
    loom = _number(1)
    own = marked.where(F.contains("_section", F.lit(str(animal))) & loom.isNotNull() & ~F.isnan(loom) & (loom < 100))
    return own.groupBy(*keys, loom.cast("int").alias("loom")).agg(F.max_by(F.struct(_number(17).alias("latency"), _number(26).alias("time_in_nest")), "row").alias("v")).select(*keys, "loom", "v.*")


def read_sheet(spark: SparkSession, path: str, loom_session: str = "L1", animal_ids: Sequence[str] = ()) -> DataFrame:
    return sheet_events(sheets(spark, path), loom_session, animal_ids)


def log_events(df: DataFrame, event_type_column: str = "event_type", time_column: str = "timestamp", end_time_column: str | None = None, row: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Events of logs in their order (``row``, or time): ids ``bonsai_1`` and on; a missing type column means ``unknown``.

    ``keys`` tell logs apart and stay in the result; without any the table is
    one session's log.
    """
    kind = F.col(event_type_column).cast("string") if event_type_column in df.columns else F.lit("unknown")
    end = F.col(end_time_column).try_cast("double") if end_time_column and end_time_column in df.columns else F.lit(None).cast("double")
    order = Window.partitionBy(*keys).orderBy(row or F.col(time_column).try_cast("double"))
    return df.select(*keys, F.concat(F.lit("bonsai_"), F.row_number().over(order)).alias("event_id"), kind.alias("event_type"), F.col(time_column).try_cast("double").alias("time_start"), end.alias("time_end"))


def read_log(spark: SparkSession, path: str, event_type_column: str = "event_type", time_column: str = "timestamp", end_time_column: str | None = None, **_) -> DataFrame:
    df = spark.read.option("header", "true").csv(path).withColumns({"_row": F.monotonically_increasing_id(), "_source": F.input_file_name()})
    return log_events(df, event_type_column, time_column, end_time_column, "_row", ["_source"]).drop("_source")


#: Readers by the type that a configuration names; more may be registered.
READERS: dict[str, Callable[..., DataFrame]] = {"master_scoring_sheet": read_sheet, "bonsai_csv": read_log}


def collect(spark: SparkSession, sources: Sequence[dict], **context) -> DataFrame:
    """Events of all configured sources; unknown types are passed over, and no source means no rows.

    A source's ``session`` (names and values) becomes columns, so that the
    sources of many sessions make one table.
    """
    out = spark.createDataFrame([], _EVENT)
    for s in sources:
        if reader := READERS.get(s["type"]):
            found = reader(spark, s["path"], **context, **{k: v for k, v in s.items() if k not in ("type", "path", "session")})
            found = found.withColumns({k: F.lit(v) for k, v in s.get("session", {}).items()})
            out = out.unionByName(found, allowMissingColumns=True)
    return out


def configured(config: dict) -> list[dict]:
    """The event sources of a configuration; a ``path_key`` stands for one of its paths."""
    out = []
    for source in (config.get("events") or {}).get("sources") or []:
        made = {k: v for k, v in source.items() if k != "path_key"}
        if source.get("path_key"):
            made["path"] = config["paths"][source["path_key"]]
        out.append(made)
    return out


def with_frames(events: DataFrame, pts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Nearest frames and errors of begin and end of each event."""
    keys = list(keys) or ["_all"]
    if keys == ["_all"]:
        events, pts = events.withColumn("_all", F.lit(0)), pts.withColumn("_all", F.lit(0))
    met = nearest(events, pts, keys, "time_start", "pts_seconds", "frame_idx", "frame_start", "frame_error_start")
    met = nearest(met, pts, keys, "time_end", "pts_seconds", "frame_idx", "frame_end", "frame_error_end")
    return met.drop("_all")
