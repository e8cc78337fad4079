"""Nearest reference point, in place of a reverse geocoding service.

Coordinates are integer micro-degrees, so distances are exact. A point is searched in the grid cell of a coordinate and
the eight cells around it; the nearest one wins, the smaller ``geo_id`` on a tie, and without any point the place is
"no info".
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import check_string
from ..session import materialize
from .joins import BROADCAST_BYTES, fits_broadcast, sized_join

PLACE_COLUMNS = ("province", "city", "district", "address")
# Points that are held together in one array.
POINTS_PER_ROW = 256
# How much finer the next grid is where a cell is too crowded.
REFINE = 4
_POINT_BYTES, _ROW_BYTES = 48, 96
_CELL = ["_cx", "_cy"]


def micro_degrees(text: Column) -> Column:
    """Decimal degrees as text -> integer micro-degrees; null where it is no number."""
    return (text.try_cast("decimal(12,6)") * 1_000_000).cast("bigint")


def _cell(value: Column, cell: int) -> Column:
    return F.floor(value / F.lit(cell)).cast("bigint")


def _distinct_points(geo: DataFrame) -> DataFrame:
    """One row per coordinate: the smallest id, as a tie would choose. A pile of copies becomes one point."""
    return geo.groupBy("lng_e6", "lat_e6").agg(F.min("geo_id").alias("geo_id"))


def _candidates(points: DataFrame, cell: int) -> tuple[DataFrame, int, int]:
    """Arrays of points by the cell they are searched from, the number of arrays a cell may have, and all their bytes.

    A crowded cell is spread over several rows so that no array grows with the data.
    """
    steps = F.array(*[F.lit(s).cast("bigint") for s in (-1, 0, 1)])
    around = (
        points.withColumn("_dx", F.explode(steps)).withColumn("_dy", F.explode(steps))
        .withColumn("_cx", _cell(F.col("lng_e6"), cell) + F.col("_dx"))
        .withColumn("_cy", _cell(F.col("lat_e6"), cell) + F.col("_dy"))
    )
    per_cell = around.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("_n"))
    slices = F.ceil(F.col("_n") / POINTS_PER_ROW).cast("bigint")
    total, rows, spread = per_cell.agg(F.sum("_n"), F.sum(slices), F.max(slices)).first()
    size = (total or 0) * _POINT_BYTES + (rows or 0) * _ROW_BYTES
    if (spread or 1) > 1:
        crowded = per_cell.filter(slices > 1).select(*_CELL, slices.alias("_slices"))
        around = sized_join(around, crowded, _CELL, "left")
        part = F.pmod(F.xxhash64("geo_id"), F.coalesce("_slices", F.lit(1)))
    else:
        part = F.lit(0)
    packed = around.groupBy(*_CELL, part.alias("_slice")).agg(
        F.collect_list(F.struct("geo_id", "lng_e6", "lat_e6")).alias("_points")
    )
    return packed.drop("_slice"), spread or 1, size


def _nearest(lng: str, lat: str) -> Column:
    """(squared distance, id) of the nearest point in ``_points``; null without any."""
    def measure(p: Column) -> Column:
        dx, dy = p["lng_e6"] - F.col(lng), p["lat_e6"] - F.col(lat)
        return F.struct((dx * dx + dy * dy).alias("d2"), p["geo_id"].alias("geo_id"))

    return F.array_min(F.transform("_points", measure))


@dataclass(frozen=True)
class Grid:
    """Candidate points by cell for one cell size."""

    cell: int
    packed: DataFrame
    spread: int
    small: bool

    def search(self, located: DataFrame, **options) -> DataFrame:
        """``located`` with the candidate array ``_points`` of each row's cell: up to ``spread`` rows per row."""
        celled = located.withColumns({"_cx": _cell(F.col("_lng"), self.cell), "_cy": _cell(F.col("_lat"), self.cell)})
        return sized_join(celled, self.packed, _CELL, "left", small=self.small, **options)

    def nearest(self, coords: DataFrame, **options) -> DataFrame:
        """``_lng, _lat, _best`` for distinct coordinates."""
        found = self.search(coords, **options).select("_lng", "_lat", _nearest("_lng", "_lat").alias("_best"))
        return found if self.spread == 1 else found.groupBy("_lng", "_lat").agg(F.min("_best").alias("_best"))


@dataclass(frozen=True)
class PointIndex:
    """Reference points prepared for searching; build it once and use it for many batches."""

    grids: tuple[Grid, ...]
    places: DataFrame
    places_small: bool

    @classmethod
    def build(
        cls,
        geo: DataFrame,
        cell: int,
        *,
        levels: Sequence[int] | None = None,
        broadcast_bytes: int | None = None,
        stored: bool = False,
    ) -> PointIndex:
        """``levels`` are the refinements of the grid that are tried first when the points do not fit a broadcast.

        Without them the grid is refined by ``REFINE`` until no cell has more points to search than one array holds.
        """
        limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
        keep = partial(materialize, label="points") if stored else lambda df: df
        points = _distinct_points(geo)
        places = keep(geo.select(F.col("geo_id").alias("_geo"), *[F.col(c).alias(f"_{c}") for c in PLACE_COLUMNS]))

        def grid(size: int) -> Grid:
            packed, spread, bytes_ = _candidates(points, size)
            return Grid(size, keep(packed), spread, bytes_ <= limit)

        grids = [grid(cell)]
        if not (grids[0].small and grids[0].spread == 1):
            points = materialize(points, "points")  # measured and packed once more for every level
            if levels is not None:
                grids = [*(grid(max(cell // factor, 1)) for factor in levels), *grids]
            while levels is None and grids[0].spread > 1 and grids[0].cell > 1:
                grids.insert(0, grid(max(grids[0].cell // REFINE, 1)))
        return cls(tuple(grids), places, fits_broadcast(places, limit))

    @property
    def in_place(self) -> bool:
        """True where each row can be answered by a broadcast join alone."""
        return len(self.grids) == 1 and self.grids[0].small and self.grids[0].spread == 1


def nearest_point(coords: DataFrame, index: PointIndex, **options) -> DataFrame:
    """``_lng, _lat, _best`` for distinct coordinates, from fine grids to the asked one.

    A point found within one fine cell's width is the nearest of all, so a coordinate in a crowded area is settled
    among few candidates; only the rest is searched again on the coarser grid.
    """
    *fine_grids, last = index.grids
    settled = []
    for grid in fine_grids:
        tried = materialize(grid.nearest(coords, **options), "nearest")
        near = F.coalesce(F.col("_best.d2") <= F.lit(grid.cell * grid.cell), F.lit(False))
        settled.append(tried.filter(near))
        coords = tried.filter(~near).select("_lng", "_lat")
    return reduce(DataFrame.unionByName, settled, last.nearest(coords, **options))


def reverse_geocode(df: DataFrame, index: PointIndex, *, lng: str = "lng", lat: str = "lat", **options) -> DataFrame:
    """Add province, city, district and address of the nearest reference point to every row of ``df``.

    With a small table of points every row finds its cell's points by a broadcast join and nothing is shuffled. With a
    large one each distinct coordinate is searched once, and the answers are joined back.
    """
    located = df.withColumns({"_lng": micro_degrees(F.col(lng)), "_lat": micro_degrees(F.col(lat))})
    if index.in_place:
        answered = index.grids[0].search(located).withColumn("_geo", _nearest("_lng", "_lat")["geo_id"])
    else:
        # Each table below is read several times; what stands behind it may be costly, such as parsing text.
        coords = located.select("_lng", "_lat").filter("_lng is not null and _lat is not null").distinct()
        best = nearest_point(materialize(coords, "coordinates"), index, **options)
        answers = materialize(best.select("_lng", "_lat", F.col("_best.geo_id").alias("_geo")), "answers")
        answered = sized_join(located, answers, ["_lng", "_lat"], "left", **options)
    named = sized_join(answered, index.places, ["_geo"], "left", small=index.places_small, **options)
    kept = [c for c in df.columns if c not in PLACE_COLUMNS]
    return named.select(*kept, *[check_string(F.col(f"_{c}")).alias(c) for c in PLACE_COLUMNS])
