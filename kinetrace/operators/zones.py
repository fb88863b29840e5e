"""Zone features: distance to zones, presence in them, and facing them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetrace.functions import geometry as G
from kinetrace.operators.reshape import parts_of
from kinetrace.operators.track import Track
from kinetrace.schema import BODY_PARTS


@dataclass(frozen=True)
class Zones:
    """Columns (by name) or numbers of a session's zones: four corners of the nest, center and radius of the circle."""

    nest: tuple | None
    loom: tuple | None = None
    radius: object = None

    @staticmethod
    def columns(prefix: str = "") -> Zones:
        """Zones held in columns ``nest_x1 .. nest_y4``, ``loom_x``, ``loom_y``, ``loom_radius``."""
        return Zones(tuple((f"{prefix}nest_x{k}", f"{prefix}nest_y{k}") for k in range(1, 5)), (f"{prefix}loom_x", f"{prefix}loom_y"), f"{prefix}loom_radius")


def name(zone: str, animal: int, part: str | None, what: str) -> str:
    """The one way that zone columns are named."""
    return f"{zone} Animal_{animal} facing" if part is None else f"{zone} Animal_{animal} {part}_{animal} {what}"


def features(zones: Zones, animals: dict[int, Sequence[str]], limit: float = 45.0) -> dict[str, Column]:
    """Columns for each zone, animal and part: distance to the zone's center and presence, and facing for each animal."""
    out: dict[str, Column] = {}
    for i, parts in animals.items():
        for p in parts:
            at = G.names(f"{p}_{i}")
            if zones.nest is not None:
                out[name("Nest", i, p, "distance")] = G.distance(at, G.centroid(zones.nest))
                out[name("Nest", i, p, "in zone")] = G.in_polygon(at, zones.nest)
            if zones.loom is not None:
                out[name("Loom", i, p, "distance")] = G.distance(at, zones.loom)
                out[name("Loom", i, p, "in zone")] = G.in_circle(at, zones.loom, zones.radius)
        if {"nose", "body_center"} <= set(parts):
            for zone, center in (("Nest", G.centroid(zones.nest) if zones.nest is not None else None), ("Loom", zones.loom)):
                if center is not None:
                    out[name(zone, i, None, "facing")] = G.facing(G.names(f"nose_{i}"), G.names(f"body_center_{i}"), center, limit)
    return out


def add(df: DataFrame, zones: Zones) -> DataFrame:
    """Adds zone features for all animals and parts that the columns name; a pure projection."""
    return df.withColumns(features(zones, parts_of(df.columns)))


def inside(animal: int, zone: str = "Nest") -> Column:
    """All parts in the zone."""
    return F.least(*[F.col(f"`{name(zone, animal, p, 'in zone')}`") for p in BODY_PARTS]) == 1


def any_inside(animal: int, zone: str = "Nest") -> Column:
    """Any part but the tail in the zone; the animal is out once this fails."""
    return F.greatest(*[F.col(f"`{name(zone, animal, p, 'in zone')}`") for p in BODY_PARTS if p != "tail_base"]) == 1


def approach(df: DataFrame, track: Track, zones: Zones, animal: int) -> DataFrame:
    """Distance of each part to the nest's border, and its change from frame to frame (positive: away)."""
    d = {f"roi_distance_{p}_animal_{animal}": G.polygon_distance(G.names(f"{p}_{animal}"), zones.nest) for p in BODY_PARTS}
    df = df.withColumns(d)
    return df.withColumns({f"roi_velocity_{p}_animal_{animal}": track.difference(f"roi_distance_{p}_animal_{animal}") for p in BODY_PARTS})
