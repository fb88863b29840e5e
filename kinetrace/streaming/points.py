"""Latency, exit and freezing after events while frames still arrive.

The streaming form of :func:`kinetrace.operators.metrics.time_points`. Rows of
one animal wait in the state until the watermark has passed them, so that rows
which come late or in any order are counted in order of time; then a small
machine for each event counts on. An event's row is given out as soon as nothing
can change it, or when its session has ended: no row within ``gap``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kinetrace.operators.metrics import FREEZE_OFF, FREEZE_ON, NEST_FRAMES
from kinetrace.workers import reachable

#: Frames before the present one that a decision may reach back to.
LOOK_BACK = FREEZE_ON + NEST_FRAMES
_ROW = ("us", "event", "frame", "inside", "slow", "fast", "far")
_FRAME, _INSIDE, _SLOW, _FAST, _FAR = range(5)
POINTS = "loom int, loom_frame bigint, until bigint, latency bigint, entry_frame bigint, stay bigint, freeze_start bigint, freeze_length bigint"


def _first(t: np.ndarray, hit: np.ndarray) -> int | None:
    return int(t[np.argmax(hit)]) if hit.any() else None


def follow(e: dict, before: np.ndarray, now: np.ndarray, over: bool) -> bool:
    """Counts an event on over new frames (``before``: the last ones already counted); True where its row is final.

    All frames before the next event have been counted once that event is known.
    """
    now = now[now[:, _FRAME] >= e["at"]]
    both = np.concatenate([before[before[:, _FRAME] >= e["at"]], now])
    t, fresh = now[:, _FRAME] - e["at"], False
    if len(now):
        e["rest"] = int(t[-1]) + 1
        count = e["inside"] + np.cumsum(now[:, _INSIDE])
        if e["latency"] is None:
            soon = now[:, _FRAME] < e["until"] if e["until"] is not None else np.ones(len(now), bool)
            fifth = _first(t, (count >= NEST_FRAMES) & soon)
            if fifth is not None:
                e["latency"], fresh = fifth - (NEST_FRAMES - 1), True
        e["inside"] = int(count[-1])
        count = e["slow"] + np.cumsum(now[:, _SLOW])
        if e["frozen"] is None:
            e["frozen"] = _first(t, count >= FREEZE_ON)
        e["slow"] = int(count[-1])
        if e["latency"] is not None and e["stay"] is None:
            rows = both if fresh else now
            left = _first(rows[:, _FRAME] - e["at"], (rows[:, _FRAME] - e["at"] >= e["latency"]) & (rows[:, _FAR] == 1))
            e["stay"] = None if left is None else left - e["latency"]
    decide = False
    if e["frozen"] is not None and not e["decided"]:
        # A fifth frame inside that is still to come tells of an entry after the freezing, but for the next few frames.
        decide = e["latency"] is not None or e["until"] is not None or over or e["rest"] - 1 >= e["frozen"] + NEST_FRAMES - 1
    if decide:
        e["decided"] = True
        if not (e["latency"] is not None and 0 < e["latency"] <= e["frozen"]):
            e["start"] = e["frozen"] - (FREEZE_ON - 1)
    if e["start"] is not None and e["length"] is None:
        rows = both if decide else now
        since = rows[:, _FRAME] - e["at"]
        count = e["fast"] + np.cumsum((since >= e["start"]) & (rows[:, _FAST] == 1))
        last = _first(since, count >= FREEZE_OFF)
        if last is not None:
            e["length"] = last - e["start"] - FREEZE_OFF
        e["fast"] = int(count[-1]) if len(count) else e["fast"]
    frozen = e["decided"] and (e["start"] is None or e["length"] is not None)
    return over or e["until"] is not None and (e["latency"] is None or e["stay"] is not None) and frozen


def _given(e: dict) -> tuple:
    length = None if e["start"] is None else e["length"] if e["length"] is not None else e["rest"] - e["start"]
    return e["k"], e["at"], e["until"], e["latency"], None if e["latency"] is None else e["at"] + e["latency"], e["stay"], e["start"], length


def _new() -> dict:
    return {"events": [], "tail": [], "made": 0, "last": None, "seen": False, "waiting": []}


def _advance(s: dict, rows: np.ndarray, over: bool) -> list[tuple]:
    """Takes rows of one session in order of time, or ends it."""
    for at in rows[rows[:, 1] == 1][:, 2].tolist():
        if s["open"] is not None:
            s["open"]["until"] = at
        s["made"] += 1
        s["open"] = {"k": s["made"], "at": at, "until": None, "inside": 0, "slow": 0, "latency": None, "stay": None, "frozen": None, "decided": False, "start": None, "fast": 0, "length": None, "rest": None}
        s["events"].append(s["open"])
    now = rows[rows[:, 1] == 0][:, 2:]
    now = now[np.argsort(now[:, _FRAME], kind="stable")]
    before = np.array(s["tail"], np.int64).reshape(-1, 5)
    s["seen"] = s["seen"] or len(now) > 0
    final = [follow(e, before, now, over) for e in s["events"]]
    done = [_given(e) for e, f in zip(s["events"], final, strict=True) if f and s["seen"]]
    s["events"] = [e for e, f in zip(s["events"], final, strict=True) if not f]
    kept = np.concatenate([before, now])
    s["tail"] = kept[kept[:, _FRAME] > kept[-1, _FRAME] - LOOK_BACK].tolist() if len(kept) else []
    return done


def drain(s: dict, waiting: np.ndarray, upto: int, gap: int) -> tuple[dict, list[tuple]]:
    """Takes what lies at or before ``upto`` (microseconds) from the waiting rows, and ends sessions without a row for ``gap``."""
    s["open"] = next((e for e in s["events"] if e["until"] is None), None)
    order = np.lexsort((waiting[:, 2], 1 - waiting[:, 1], waiting[:, 0]))
    waiting, out = waiting[order], []
    ready = waiting[waiting[:, 0] <= upto]
    at = ready[:, 0]
    cuts = (np.flatnonzero(np.diff(at) > gap) + 1).tolist()
    for a, b in zip([0, *cuts], [*cuts, len(ready)], strict=True):
        if a == b:
            continue
        if s["last"] is not None and at[a] - s["last"] > gap:
            out += _advance(s, ready[:0], True)
            s = _new() | {"open": None}
        out += _advance(s, ready[a:b], False)
        s["last"] = int(at[b - 1])
    rest = waiting[len(ready) :]
    if s["last"] is not None and upto - s["last"] > gap:
        out += _advance(s, ready[:0], True)
        s = _new() | {"open": None}
    s["waiting"] = rest.tolist()
    del s["open"]
    return s, out


def time_points(
    df: DataFrame, keys: Sequence[str], late: str, gap: int, time: str = "time", frame: str = "frame_idx", event: str = "event",
    inside: str = "inside", near: str = "near", slow: str = "slow", calm: str = "calm",
) -> DataFrame:
    """Time points of a stream: keys, animal and the columns of the batch form.

    ``df``: keys, animal, ``frame``, ``time`` (a timestamp that never falls as
    frames of an animal go up), the four flags, and ``event``: true in a row
    that is not a frame but an event of the session, one for each animal. Rows
    more than ``late`` behind the latest time seen are lost, as the watermark
    says. A session ends after ``gap`` seconds without a row of that animal;
    what comes after it is a new session, whose events count from 1. Rows without a
    frame or a time are left out; an animal without frames has no rows. The
    result does not depend on how rows fall into micro-batches.
    """
    reachable(df.sparkSession)
    who = [*keys, "animal"]
    flag = lambda c: F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))
    rows = df.where(F.col(frame).isNotNull() & F.col(time).isNotNull()).withWatermark(time, late)
    rows = rows.select(
        *who, time, F.unix_micros(F.col(time)).alias("us"), flag(F.col(event)).alias("event"), F.col(frame).cast("bigint").alias("frame"),
        flag(F.col(inside)).alias("inside"), flag(F.col(slow)).alias("slow"), flag(~F.coalesce(F.col(calm), F.lit(False))).alias("fast"), flag(~F.col(near)).alias("far"),
    )
    names = [*who, *[c.split()[0] for c in POINTS.split(", ")]]
    wide = gap * 1_000_000

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        s = json.loads(state.get[0]) if state.exists else _new()
        parts = [np.array(s["waiting"], np.int64).reshape(-1, len(_ROW))]
        if not state.hasTimedOut:
            parts += [np.stack([pdf[c].to_numpy(np.int64) for c in _ROW], axis=1) for pdf in batches]
        passed = state.getCurrentWatermarkMs()
        s, out = drain(s, np.concatenate(parts), passed * 1000, wide)
        if s["waiting"] or s["last"] is not None:
            state.update((json.dumps(s),))
            # Wake when the first waiting row is due, or else when the session ends.
            due = s["waiting"][0][0] if s["waiting"] else s["last"] + wide
            state.setTimeoutTimestamp(max(due // 1000, passed + 1))
        elif state.exists:
            state.remove()
        if out:
            # Whole columns at once: converting a made table costs several times as much, for every animal.
            made = {c: [k] * len(out) for c, k in zip(who, key, strict=True)}
            made |= {c: pd.array(list(v), dtype="Int64") for c, v in zip(names[len(who) :], zip(*out, strict=True), strict=True)}
            yield pd.DataFrame(made)

    kinds = dict(df.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in who], POINTS])
    return rows.groupBy(*who).applyInPandasWithState(run, schema, "state string", "append", GroupStateTimeout.EventTimeTimeout)
