"""Images as rows of pixels: stencils, edges, labelled regions, box sums and masks.

An image is a set of rows ``image, y, values`` (whole numbers from x = 0 on).
Work is dealt by tiles of neighbouring rows. A stencil's tile also gets the rows
around it that it reads; labels and prefix sums are made within a tile and then
put together from the tiles' borders alone: runs that touch across a border are
united, and the last row of each tile is carried into those below. So a task
holds one tile, and per image only borders meet.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetrace.functions.geometry import Point, col
from kinetrace.sources.stage import shared_folder, stored
from kinetrace.workers import reachable

#: Rows of a tile.
TILE = 256
#: Thresholds of the edge detector, and tan(22.5 degrees) in 15 binary places.
LOW, HIGH, TANGENT = 50, 150, 13573
Work = Callable[[np.ndarray], np.ndarray]


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers in order and their values; missing values and the ends of short rows are 0."""
    order = np.argsort(table.column("y").to_numpy(), kind="stable")
    y = table.column("y").to_numpy()[order]
    rows = table.column("values").combine_chunks()
    offsets, flat = rows.offsets.to_numpy(), rows.values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(offsets)
    if rows.null_count:
        sizes = np.where(rows.is_null().to_numpy(zero_copy_only=False), 0, sizes)
    out = np.zeros((len(y), int(sizes.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(y)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat[np.repeat(offsets[:-1], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
    return y, out[order]


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(np.ascontiguousarray(matrix).reshape(-1), kind))


def stencil(rows: DataFrame, work: Work, reach: int, tile: int = TILE) -> DataFrame:
    """``work`` on each tile with the ``reach`` rows above and below it; of what it returns, the tile's own rows stay.

    ``work`` treats the matrix's border as the image's: a border within the
    image is farther from the tile's own rows than the stencil reaches.
    """
    reachable(rows.sparkSession)
    kind = rows.schema["image"].dataType.simpleString()
    near = F.sequence(F.floor((F.col("y") - reach) / tile), F.floor((F.col("y") + reach) / tile))
    dealt = rows.select("image", F.col("y").cast("long").alias("y"), F.col("values").cast("array<bigint>").alias("values")).withColumn("tile", F.explode(near))

    def run(table: pa.Table) -> pa.Table:
        y, matrix = _matrix(table)
        number = table.column("tile")[0].as_py()
        own = (y >= number * tile) & (y < (number + 1) * tile)
        made = work(matrix)[own] if own.any() else matrix[:0]
        image = pa.array([table.column("image")[0].as_py()] * int(own.sum()), table.schema.field("image").type)
        return pa.table({"image": image, "y": pa.array(y[own]), "values": _lists(made, pa.int64())})

    return dealt.groupBy("image", "tile").applyInArrow(run, f"image {kind}, y bigint, values array<bigint>")


def _shifted(a: np.ndarray, dy: int, dx: int, mode: str = "edge") -> np.ndarray:
    """The value at (y + dy, x + dx) of each pixel; beyond the border the nearest one, or 0."""
    padded = np.pad(a, ((max(0, -dy), max(0, dy)), (max(0, -dx), max(0, dx))), mode=mode)
    return padded[max(0, dy) : max(0, dy) + a.shape[0], max(0, dx) : max(0, dx) + a.shape[1]]


def blurred(a: np.ndarray) -> np.ndarray:
    """Mean by the weights 1, 4, 6, 4, 1 along both axes, rounded to whole numbers."""
    for dy, dx in ((1, 0), (0, 1)):
        a = sum(w * _shifted(a, k * dy, k * dx) for k, w in zip(range(-2, 3), (1, 4, 6, 4, 1), strict=True))
    return (a + 128) // 256


def gradients(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Changes along x and y, smoothed by 1, 2, 1 across."""
    tall = _shifted(a, -1, 0) + 2 * a + _shifted(a, 1, 0)
    steep = _shifted(a, 1, 0) - _shifted(a, -1, 0)
    return _shifted(tall, 0, 1) - _shifted(tall, 0, -1), _shifted(steep, 0, -1) + 2 * steep + _shifted(steep, 0, 1)


def _candidates(low: int, high: int, blur: bool) -> Work:
    """1 where a ridge of the gradient exceeds ``low``, 2 where it exceeds ``high``, else 0."""

    def work(a: np.ndarray) -> np.ndarray:
        if not a.size:
            return a
        gx, gy = gradients(blurred(a) if blur else a)
        m, x, y = np.abs(gx) + np.abs(gy), np.abs(gx), np.abs(gy) << 15
        at = lambda dy, dx: _shifted(m, dy, dx, "constant")
        flat, steep = y < x * TANGENT, y > x * TANGENT + (x << 16)
        across = (m > at(0, -1)) & (m >= at(0, 1))
        down = (m > at(-1, 0)) & (m >= at(1, 0))
        falling = (m > at(-1, -1)) & (m > at(1, 1))
        rising = (m > at(-1, 1)) & (m > at(1, -1))
        ridge = np.where(flat, across, np.where(steep, down, np.where((gx < 0) != (gy < 0), rising, falling)))
        return np.where(ridge & (m > low), 1 + (m > high), 0)

    return work


def edge_candidates(rows: DataFrame, low: int = LOW, high: int = HIGH, blur: bool = True, tile: int = TILE) -> DataFrame:
    """Ridges of the gradient: 2 for strong ones, 1 for weak ones, else 0."""
    return stencil(rows, _candidates(low, high, blur), 4, tile)


def _grown(a: np.ndarray, size: int, most: bool) -> np.ndarray:
    """Largest (or least) value of a square around each pixel; what lies outside the image does not count."""
    for axis in (0, 1):
        r, n = size // 2, a.shape[axis]
        pad = [(r, r) if k == axis else (0, 0) for k in (0, 1)]
        padded = np.pad(a, pad, constant_values=np.iinfo(np.int64).min if most else np.iinfo(np.int64).max)
        parts = [np.take(padded, np.arange(k, k + n), axis=axis) for k in range(2 * r + 1)]
        a = np.maximum.reduce(parts) if most else np.minimum.reduce(parts)
    return a


def closed(rows: DataFrame, size: int = 3, tile: int = TILE) -> DataFrame:
    """Gaps narrower than ``size`` are closed: grown, then shrunk."""
    return stencil(rows, lambda a: _grown(_grown(a, size, True), size, False) if a.size else a, 2 * (size // 2), tile)


def opened(rows: DataFrame, size: int = 3, tile: int = TILE) -> DataFrame:
    """Parts narrower than ``size`` go: shrunk, then grown."""
    return stencil(rows, lambda a: _grown(_grown(a, size, False), size, True) if a.size else a, 2 * (size // 2), tile)


# Labelled regions


def _joined(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each of ``count`` nodes' groups, which pairs (a, b) unite."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label != (jumped := label[label])).any():
            label = jumped
        if (label == before).all():
            return label


def _touching(starts: np.ndarray, ends: np.ndarray, above_starts: np.ndarray, above_ends: np.ndarray, slack: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a run and one of the row above that touch; both in order and apart. ``slack`` 1 lets corners touch."""
    low = np.searchsorted(above_ends, starts - slack, "right")
    high = np.searchsorted(above_starts, ends + slack, "left")
    n = np.maximum(0, high - low)
    return np.repeat(np.arange(len(starts)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def runs(rows: DataFrame, corners: bool = True, tile: int = TILE) -> DataFrame:
    """Runs of pixels that are not 0: image, tile, label (within the tile), y, first and end x (exclusive), and the largest value."""
    reachable(rows.sparkSession)
    kind, slack = rows.schema["image"].dataType.simpleString(), int(corners)
    dealt = rows.select("image", F.col("y").cast("long").alias("y"), F.col("values").cast("array<bigint>").alias("values"), F.floor(F.col("y") / tile).alias("tile"))

    def run(table: pa.Table) -> pa.Table:
        y, a = _matrix(table)
        edge = np.diff((a != 0).astype(np.int8), axis=1, prepend=0, append=0)
        r, first = np.nonzero(edge == 1)
        end = np.nonzero(edge == -1)[1]
        width = a.shape[1] + 3  # so that runs of one row do not reach into the next
        shift = r * 0 + (y[r] - y[0]) * width if len(r) else r
        i, j = _touching(shift + first, shift + end, shift + width + first, shift + width + end, slack)
        label = _joined(len(r), i, j)
        peak = np.maximum.reduceat(np.append(a.reshape(-1), 0), np.stack([r * a.shape[1] + first, r * a.shape[1] + end], 1).reshape(-1))[::2] if len(r) else first
        same = lambda name: pa.array([table.column(name)[0].as_py()] * len(r), table.schema.field(name).type)
        return pa.table({"image": same("image"), "tile": same("tile"), "label": pa.array(label, pa.int64()), "y": pa.array(y[r], pa.int64()), "first": pa.array(first, pa.int64()), "end": pa.array(end, pa.int64()), "peak": pa.array(peak, pa.int64())})

    return dealt.groupBy("image", "tile").applyInArrow(run, f"image {kind}, tile bigint, label bigint, y bigint, first bigint, end bigint, peak bigint")


def _united(found: DataFrame, corners: bool, tile: int) -> DataFrame:
    """For labels that touch another tile: image, tile, label and the tile and label that stand for their region."""
    kind, slack = found.schema["image"].dataType.simpleString(), int(corners)
    top, bottom = F.col("y") == F.col("tile") * tile, F.col("y") == (F.col("tile") + 1) * tile - 1
    # A tile's last row meets the first of the next at that one's number.
    border = found.where(top | bottom).withColumn("sides", F.concat(F.when(top, F.array(F.lit(False))).otherwise(F.array().cast("array<boolean>")), F.when(bottom, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))))
    border = border.select("image", "tile", "label", "first", "end", F.explode("sides").alias("above")).withColumn("at", F.col("tile") + F.col("above").cast("int"))

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by("first")
        above = table.column("above").to_numpy()
        first, end, label = (table.column(c).to_numpy() for c in ("first", "end", "label"))
        i, j = _touching(first[~above], end[~above], first[above], end[above], slack)
        links = np.unique(np.stack([label[above][j], label[~above][i]], axis=1), axis=0)
        image = pa.array([table.column("image")[0].as_py()] * len(links), table.schema.field("image").type)
        at = np.full(len(links), table.column("at")[0].as_py(), np.int64)
        return pa.table({"image": image, "tile_a": pa.array(at - 1), "label_a": pa.array(links[:, 0], pa.int64()), "tile_b": pa.array(at), "label_b": pa.array(links[:, 1], pa.int64())})

    def unite(table: pa.Table) -> pa.Table:
        a, b = (np.stack([table.column(f"tile_{s}").to_numpy(), table.column(f"label_{s}").to_numpy()], axis=1) for s in "ab")
        nodes, number = np.unique(np.concatenate([a, b]), axis=0, return_inverse=True)
        root = nodes[_joined(len(nodes), number[: len(a)], number[len(a) :])]
        image = pa.array([table.column("image")[0].as_py()] * len(nodes), table.schema.field("image").type)
        return pa.table({"image": image, "tile": pa.array(nodes[:, 0]), "label": pa.array(nodes[:, 1]), "root_tile": pa.array(root[:, 0]), "root_label": pa.array(root[:, 1])})

    links = border.groupBy("image", "at").applyInArrow(meet, f"image {kind}, tile_a bigint, label_a bigint, tile_b bigint, label_b bigint")
    return links.groupBy("image").applyInArrow(unite, f"image {kind}, tile bigint, label bigint, root_tile bigint, root_label bigint")


def labelled(rows: DataFrame, corners: bool = True, tile: int = TILE) -> DataFrame:
    """Runs of :func:`runs` with the tile and label that stand for their region in the whole image (``root_tile``, ``root_label``).

    Runs are written to the shared folder, since borders and results both read
    them. With ``corners``, pixels that touch at a corner belong together. A
    null image is one image.
    """
    found = stored(runs(rows, corners, tile), shared_folder(rows.sparkSession), "runs")
    roots = _united(found, corners, tile).select(F.col("image").alias("i"), F.col("tile").alias("t"), F.col("label").alias("l"), "root_tile", "root_label")
    met = found.join(roots, F.col("image").eqNullSafe(F.col("i")) & (F.col("tile") == F.col("t")) & (F.col("label") == F.col("l")), "left").drop("i", "t", "l")
    return met.withColumns({"root_tile": F.coalesce("root_tile", "tile"), "root_label": F.coalesce("root_label", "label")})


def regions(rows: DataFrame, corners: bool = True, tile: int = TILE) -> DataFrame:
    """Regions of pixels that are not 0: their topmost and then leftmost pixel, area, box (inclusive), centre and largest value."""
    n = F.col("end") - F.col("first")
    found = labelled(rows, corners, tile).groupBy("image", "root_tile", "root_label").agg(
        F.min(F.struct("y", "first")).alias("at"), F.sum(n).alias("area"), F.min("first").alias("min_x"), (F.max("end") - 1).alias("max_x"), F.min("y").alias("min_y"), F.max("y").alias("max_y"),
        F.sum(n * (F.col("first") + F.col("end") - 1)).alias("sx"), F.sum(n * F.col("y")).alias("sy"), F.max("peak").alias("peak"),
    )
    return found.select("image", F.col("at.y").alias("first_y"), F.col("at.first").alias("first_x"), "area", "min_x", "max_x", "min_y", "max_y", (F.col("sx") / 2 / F.col("area")).alias("center_x"), (F.col("sy") / F.col("area")).alias("center_y"), "peak")


def edges(rows: DataFrame, low: int = LOW, high: int = HIGH, blur: bool = True, tile: int = TILE) -> DataFrame:
    """Runs of edge pixels: weak ridges stay where their region holds a strong one. Columns image, y, first, end (exclusive)."""
    whole = labelled(edge_candidates(rows, low, high, blur, tile), True, tile)
    group = ["image", "root_tile", "root_label"]
    strong = whole.groupBy(*group).agg(F.max("peak").alias("p")).where("p = 2").select(*[F.col(c).alias(f"_{c}") for c in group])
    held = F.col("image").eqNullSafe(F.col("_image")) & (F.col("root_tile") == F.col("_root_tile")) & (F.col("root_label") == F.col("_root_label"))
    return whole.join(strong, held, "left_semi").select("image", "y", "first", "end")


def as_rows(runs_: DataFrame, rows: DataFrame) -> DataFrame:
    """A mask of the size of ``rows`` that is 1 on the runs."""
    parts = runs_.groupBy("image", "y").agg(F.collect_list(F.struct("first", "end")).alias("parts")).select(F.col("image").alias("i"), F.col("y").alias("j"), "parts")
    met = rows.join(parts, F.col("image").eqNullSafe(F.col("i")) & (F.col("y") == F.col("j")), "left")
    cells = F.expr("transform(values, (v, x) -> CAST(coalesce(exists(parts, p -> x >= p.first AND x < p.end), false) AS BIGINT))")
    return met.select("image", "y", cells.alias("values"))


# Sums over boxes


def summed(rows: DataFrame, tile: int = TILE) -> DataFrame:
    """Sums of all values above and to the left of each pixel, itself included: image, y, sums.

    Missing rows count as 0. Tiles are summed alone; the last sums of each are
    added up over the image's tiles and carried into those below.
    """
    reachable(rows.sparkSession)
    kind = rows.schema["image"].dataType.simpleString()
    dealt = rows.select("image", F.col("y").cast("long").alias("y"), F.col("values").cast("array<bigint>").alias("values"), F.floor(F.col("y") / tile).alias("tile"))

    def local(table: pa.Table) -> pa.Table:
        y, a = _matrix(table)
        same = lambda name: pa.array([table.column(name)[0].as_py()] * len(y), table.schema.field(name).type)
        return pa.table({"image": same("image"), "tile": same("tile"), "y": pa.array(y), "sums": _lists(a.cumsum(axis=0).cumsum(axis=1), pa.int64()), "final": pa.array(y == y[-1])})

    parts = stored(dealt.groupBy("image", "tile").applyInArrow(local, f"image {kind}, tile bigint, y bigint, sums array<bigint>, final boolean"), shared_folder(rows.sparkSession), "sums")

    def carry(table: pa.Table) -> pa.Table:
        tile_of, last = _matrix(table.select(["y", "values"]))
        # A row that is shorter than others sums to its last value beyond its end.
        sizes = np.array([len(v) for v in table.column("values").to_pylist()])[np.argsort(table.column("y").to_numpy(), kind="stable")]
        for k, n in enumerate(sizes.tolist()):
            last[k, n:] = last[k, n - 1] if n else 0
        before = np.cumsum(last, axis=0) - last
        image = pa.array([table.column("image")[0].as_py()] * len(tile_of), table.schema.field("image").type)
        return pa.table({"image": image, "tile": pa.array(tile_of), "carried": _lists(before, pa.int64())})

    ends = parts.where("final").select("image", F.col("tile").alias("y"), F.col("sums").alias("values"))
    carried = ends.groupBy("image").applyInArrow(carry, f"image {kind}, tile bigint, carried array<bigint>").select(F.col("image").alias("i"), F.col("tile").alias("t"), "carried")
    met = parts.join(carried, F.col("image").eqNullSafe(F.col("i")) & (F.col("tile") == F.col("t")))
    return met.select("image", "y", F.expr("transform(sums, (s, x) -> s + carried[x])").alias("sums"))


def box_sums(rows: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """For each pixel the sum and number of the pixels within ``radius`` along both axes, cut at the image's border: image, y, sums, counts.

    Whatever the radius, a pixel reads four prefix sums: two of the row at the
    box's lower border, two of that above its upper one. Rows of an image have
    one length and no holes.
    """
    table = stored(summed(rows, tile), shared_folder(rows.sparkSession), "prefix")
    size = table.groupBy("image").agg(F.min("y").alias("low"), F.max("y").alias("high")).select(F.col("image").alias("i"), "low", "high")
    met = table.join(size, F.col("image").eqNullSafe(F.col("i"))).drop("i")
    y = F.col("y")
    lower = F.sequence(F.greatest("low", y - radius), F.when(y == F.col("high"), y).otherwise(y - radius))
    upper = F.when(y + radius + 1 <= F.col("high"), F.array(y + radius + 1))
    as_lower = F.when((y == F.col("high")) | (y - radius >= F.col("low")), F.transform(lower, lambda t: F.struct(t.alias("to"), F.lit(True).alias("lower"))))
    none = F.array().cast("array<struct<to:bigint,lower:boolean>>")
    to = F.concat(F.coalesce(as_lower, none), F.coalesce(F.transform(upper, lambda t: F.struct(t.alias("to"), F.lit(False).alias("lower"))), none))
    sent = met.withColumn("to", F.explode(to)).select("image", F.col("to.to").alias("at"), F.col("to.lower").alias("lower"), "y", "low", "sums")
    pairs = sent.groupBy("image", "at").agg(F.max(F.when(F.col("lower"), F.struct("y", "sums"))).alias("b"), F.max(F.when(~F.col("lower"), F.struct("y", "sums"))).alias("t"), F.min("low").alias("low"))
    rows_in = F.col("b.y") - F.coalesce(F.col("t.y"), F.col("low") - 1)
    flat = pairs.select("image", F.col("at").alias("y"), F.col("b.sums").alias("b"), F.expr("transform(b.sums, (v, x) -> v - coalesce(t.sums[x], 0))").alias("d"), rows_in.alias("n"))
    right, left = f"least(x + {radius}, size(d) - 1)", f"x - {radius} - 1"
    return flat.select("image", "y", F.expr(f"transform(d, (v, x) -> d[{right}] - if({left} >= 0, d[greatest({left}, 0)], 0))").alias("sums"), F.expr(f"transform(d, (v, x) -> CAST(n AS BIGINT) * ({right} - greatest({left}, -1)))").alias("counts"))


def smooth_regions(rows: DataFrame, radius: int, most: float, least_area: int, low: int = LOW, high: int = HIGH, clean: int = 3, tile: int = TILE) -> DataFrame:
    """Regions where edges are rare, from pixels to boxes: those of ``least_area`` pixels or more.

    A pixel counts as smooth where at most the share ``most`` of the pixels
    within ``radius`` are edges; the mask's gaps narrower than ``clean`` are closed and its
    narrower parts go.
    """
    plain = rows.select("image", F.col("y").cast("long").alias("y"), F.col("values").cast("array<bigint>").alias("values"))
    mask = stored(as_rows(edges(plain, low, high, True, tile), plain), shared_folder(rows.sparkSession), "edges")
    near = box_sums(mask, radius, tile)
    smooth = near.select("image", "y", F.expr(f"transform(sums, (s, x) -> CAST(s <= {most!r}D * counts[x] AS BIGINT))").alias("values"))
    return regions(opened(closed(smooth, clean, tile), clean, tile), True, tile).where(F.col("area") >= least_area)


# Masks


def mask_runs(df: DataFrame, keys: Sequence[str], corners: Sequence[Point]) -> DataFrame:
    """Whole-numbered cells inside a polygon as runs of rows: keys, y, first and end (exclusive).

    For each row, the edges that cross it are sorted, and cells lie between
    pairs of crossings; they are those of :func:`kinetrace.functions.geometry.in_polygon`.
    """
    points = [(col(x).cast("double"), col(y).cast("double")) for x, y in corners]
    ys = [p[1] for p in points]
    rows = df.select(*keys, *[c.alias(f"_{a}{k}") for k, p in enumerate(points) for a, c in zip("xy", p, strict=True)], F.explode(F.sequence(F.ceil(F.least(*ys)).cast("long"), F.floor(F.greatest(*ys)).cast("long"))).alias("y")).where("y is not null")
    n, crossings = len(points), []
    for k in range(n):
        ax, ay, bx, by = f"_x{k}", f"_y{k}", f"_x{(k + 1) % n}", f"_y{(k + 1) % n}"
        # A row at an edge's lower end, in y, does not cross it.
        crossings.append(f"if(y > least({ay}, {by}) AND y <= greatest({ay}, {by}), if({ax} = {bx}, {ax}, (y - {ay}) * ({bx} - {ax}) / ({by} - {ay}) + {ax}), NULL)")
    met = rows.select(*keys, "y", F.expr(f"array_sort(filter(array({', '.join(crossings)}), c -> c IS NOT NULL))").alias("_c"))
    pairs = met.withColumn("_k", F.explode(F.expr("filter(sequence(0, greatest(size(_c) - 2, 0)), k -> k % 2 = 0 AND k + 1 < size(_c))")))
    first, end = F.floor(F.get("_c", F.col("_k"))) + 1, F.floor(F.get("_c", F.col("_k") + 1)) + 1
    return pairs.select(*keys, "y", first.cast("long").alias("first"), end.cast("long").alias("end")).where("first < end")


def cells(runs_: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Runs as one row a cell: keys, y, x."""
    return runs_.where("first < end").select(*keys, "y", F.explode(F.sequence(F.col("first"), F.col("end") - 1)).alias("x"))


def area_of(runs_: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of cells of each mask."""
    return runs_.groupBy(*keys).agg(F.sum(F.col("end") - F.col("first")).alias("cells"))


def number(c: str, scale: float = 256.0, middle: int = 128) -> Column:
    """Numbers around 0 as grey values from 0 to 255."""
    return F.transform(c, lambda v: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(v.cast("double") * scale).cast("int") + middle)))
