"""Raster map algebra on cell tables ``col, row, value``; row 0 is the top row.

A table may carry ``zoom`` and ``tile_col, tile_row``. Each operator is a set of joins and grouped
aggregates on cell keys, so a layer of any size is spread over all tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.spatial import MERCATOR_RADIUS, to_mercator
from ..session import stage

TILE = 256


@dataclass(frozen=True)
class Grid:
    """Where cells lie: top-left corner and cell size."""

    x0: float
    y0: float
    size: float


def world_grid(zoom: int, tile: int = TILE) -> Grid:
    """Global web-mercator layout: 2^zoom x 2^zoom tiles."""
    half = math.pi * MERCATOR_RADIUS
    return Grid(-half, half, 2 * half / (tile * 2**zoom))


def layout_zoom(size: float, tile: int = TILE, tolerance: float = 0.1) -> int:
    """Zoom of the layout for source cells of ``size`` metres: the coarsest one whose cells are not larger,
    give or take ``tolerance``."""
    return max(0, math.ceil(math.log2(world_grid(0, tile).size / (size * (1 + tolerance)))))


def tile_to_layout(
    cells: DataFrame, lon: str, lat: str, width: float, height: float, zoom: int, tile: int = TILE
) -> DataFrame:
    """Resample a layer to the global layout: a target cell takes the source cell its centre lies in.

    ``lon`` and ``lat`` are the centres of source cells of ``width`` x ``height`` degrees. A source cell goes
    to all target cells whose centres its footprint covers, so coarse sources leave no gaps and fine ones are
    thinned out before the shuffle. A centre on an edge takes the smallest source column, then row.
    """
    g, side, edge = world_grid(zoom, tile), tile * 2**zoom, 1e-9
    south, north = F.greatest(F.col(lat) - height / 2, F.lit(-89.9)), F.least(F.col(lat) + height / 2, F.lit(89.9))
    corners = cells.withColumns(
        {"__a": to_mercator(F.col(lon) - width / 2, north), "__b": to_mercator(F.col(lon) + width / 2, south)}
    )
    first = lambda at: F.greatest(F.ceil(at / g.size - 0.5 - edge), F.lit(0)).cast("int")
    last = lambda at: F.least(F.floor(at / g.size - 0.5 + edge), F.lit(side - 1)).cast("int")
    spans = corners.select(
        "col", "row", "value",
        first(F.col("__a.x") - g.x0).alias("c0"), last(F.col("__b.x") - g.x0).alias("c1"),
        first(F.lit(g.y0) - F.col("__a.y")).alias("r0"), last(F.lit(g.y0) - F.col("__b.y")).alias("r1"),
    ).filter("c0 <= c1 and r0 <= r1")
    placed = spans.withColumn("c", F.explode(F.sequence("c0", "c1"))).withColumn("r", F.explode(F.sequence("r0", "r1")))
    out = placed.groupBy("c", "r").agg(F.min_by("value", F.struct("col", "row")).alias("value"))
    return out.select(
        F.lit(zoom).alias("zoom"),
        F.floor(F.col("c") / tile).cast("int").alias("tile_col"),
        F.floor(F.col("r") / tile).cast("int").alias("tile_row"),
        F.col("c").cast("int").alias("col"),
        F.col("r").cast("int").alias("row"),
        "value",
    )


def pyramid(cells: DataFrame, max_zoom: int, how: str = "nearest") -> DataFrame:
    """All zoom levels from ``max_zoom`` down to 0 in one table with ``zoom``.

    Each level halves columns and rows of the level below it. ``nearest`` keeps the top-left cell that
    exists, ``mean`` averages. A level is staged before the next one reads it, so the base is
    aggregated once and not once per level; level sizes fall by four.
    """
    agg = F.avg("value") if how == "mean" else F.min_by("value", F.struct("row", "col"))
    level = cells.select(F.lit(max_zoom).alias("zoom"), "col", "row", "value")
    out = level
    for z in range(max_zoom - 1, -1, -1):
        half = level.groupBy(
            F.floor(F.col("col") / 2).cast("int").alias("c"), F.floor(F.col("row") / 2).cast("int").alias("r")
        ).agg(agg.alias("value"))
        level = stage(half.select(F.lit(z).alias("zoom"), F.col("c").alias("col"), F.col("r").alias("row"), "value"), "level")
        out = out.union(level)
    return out


def level(pyramid_table: DataFrame, zoom: int) -> DataFrame:
    """One zoom level; on a table partitioned by zoom only its folder is read."""
    return pyramid_table.filter(F.col("zoom") == zoom)


def stitch(cells: DataFrame, strip: int = 4096) -> DataFrame:
    """Rows of the grid in order. A grid row is cut into strips of at most ``strip`` columns, so no
    strip outgrows one cell of a table."""
    pairs = F.sort_array(F.collect_list(F.struct("col", "value")))
    strips = cells.groupBy("row", F.floor(F.col("col") / strip).cast("int").alias("strip")).agg(
        F.min("col").alias("first_col"), F.transform(pairs, lambda p: p["value"]).alias("values")
    )
    return strips.orderBy("row", "strip")


def extent(cells: DataFrame, grid: Grid) -> DataFrame:
    """Bounds and midpoint of the cells that exist."""
    c = cells.agg(F.min("col").alias("c0"), F.max("col").alias("c1"), F.min("row").alias("r0"), F.max("row").alias("r1"))
    box = c.select(
        (F.lit(grid.x0) + F.col("c0") * grid.size).alias("xmin"),
        (F.lit(grid.x0) + (F.col("c1") + 1) * grid.size).alias("xmax"),
        (F.lit(grid.y0) - (F.col("r1") + 1) * grid.size).alias("ymin"),
        (F.lit(grid.y0) - F.col("r0") * grid.size).alias("ymax"),
    )
    mid_x = F.col("xmin") + (F.col("xmax") - F.col("xmin")) / 2
    mid_y = F.col("ymin") + (F.col("ymax") - F.col("ymin")) / 2
    return box.withColumns({"xmid": mid_x, "ymid": mid_y})


def divide(cells: DataFrame, by: float) -> DataFrame:
    """Cell-wise division."""
    return cells.withColumn("value", F.col("value") / F.lit(float(by)))


def focal_mean(cells: DataFrame, n: int = 1) -> DataFrame:
    """Mean over the (2n+1) x (2n+1) square around each existing cell, edges using what is there.

    Two passes, along rows and then along columns, send 2 (2n+1) rows per cell instead of (2n+1)^2.
    Sums and counts combine before each shuffle; ``own`` marks targets that are cells themselves.
    """
    steps = F.sequence(F.lit(-n), F.lit(n))
    across = cells.select("col", "row", "value", F.explode(steps).alias("d"))
    sums = across.groupBy((F.col("col") + F.col("d")).alias("col"), "row").agg(
        F.sum("value").alias("s"), F.count("value").alias("k"), F.max(F.col("d") == 0).alias("own")
    )
    down = sums.select("col", "row", "s", "k", "own", F.explode(steps).alias("d"))
    total = down.groupBy("col", (F.col("row") + F.col("d")).alias("row")).agg(
        F.sum("s").alias("s"), F.sum("k").alias("k"), F.max((F.col("d") == 0) & F.col("own")).alias("own")
    )
    return total.filter("own").select("col", "row", F.try_divide("s", "k").alias("value"))


def point_values(cells: DataFrame, grid: Grid, points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Value of the cell each point lies in; NULL outside the layer. Points and cells meet on the cell key."""
    keyed = points.withColumns(
        {
            "col": F.floor((F.col(x) - grid.x0) / grid.size).cast("int"),
            "row": F.floor((F.lit(grid.y0) - F.col(y)) / grid.size).cast("int"),
        }
    )
    return keyed.join(cells.select("col", "row", "value"), ["col", "row"], "left").drop("col", "row")


def grid_maximum(cells: DataFrame, grid: Grid, stride: float) -> DataFrame:
    """Largest positive value met on a grid of points every ``stride`` units, with the first such point.

    Which cells hold a grid point follows from their own position, so the search is one filtered scan
    plus a top-1 rather than a lookup per point.
    """
    box = extent(cells, grid).select(F.struct("xmin", "xmax", "ymin", "ymax").alias("b")).scalar()
    b = cells.withColumn("__b", box)
    left, top = F.lit(grid.x0) + F.col("col") * grid.size, F.lit(grid.y0) - F.col("row") * grid.size
    x_start, y_start = F.col("__b.xmin").cast("bigint"), F.col("__b.ymin").cast("bigint")
    px = x_start + F.greatest(F.ceil((left - x_start) / stride), F.lit(0)) * F.lit(stride)
    py = y_start + F.greatest(F.floor((top - grid.size - y_start) / stride) + 1, F.lit(0)) * F.lit(stride)
    on_grid = b.withColumns({"x": px.cast("double"), "y": py.cast("double")}).filter(
        (F.col("x") < left + grid.size) & (F.col("x") < F.col("__b.xmax").cast("bigint"))
        & (F.col("y") <= top) & (F.col("y") < F.col("__b.ymax").cast("bigint")) & (F.col("value") > 0)
    )
    return on_grid.orderBy(F.col("value").desc(), "x", "y").limit(1).select("x", "y", "value")
