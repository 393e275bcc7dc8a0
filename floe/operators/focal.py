"""Windowed texture of two co-registered rasters.

Two routes give the same values:

* cells: ``masked_mean`` and ``normprod`` are window functions over a cell table.
  Cells are first copied into bounded blocks with a halo, one shuffle by block;
  every window afterwards is partitioned inside a block, so it needs only sorts
  and no task ever holds a whole raster row or column.
* tiles: ``texture_tiles`` exchanges only halo strips between array tiles and
  computes each tile with NumPy box sums. This is the route for archive scale.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floe.operators.tile_texture import sampled_function, tile_function
from floe.schema import MIN_VALID_FRACTION

BLOCK = 256
# cells a task windows at once: its sorts take about a kilobyte of each, whatever the raster's size
TASK_CELLS = 250_000
_BLOCK_KEYS = ("scene_id", "by", "bx")


def check_width(width: int) -> None:
    if width < 3 or width % 2 == 0:
        raise ValueError("texture windows must be odd and at least 3")


def _block_tasks(cells: DataFrame, halo: int, block: int, grids: DataFrame | None) -> int:
    """Tasks for all blocks with their halos, from one row a scene."""
    shapes = cells if grids is None else grids
    one = shapes.select("scene_id", "height", "width").distinct()
    copied = lambda n: F.col(n) + 2 * halo * F.ceil(F.col(n) / block)
    total = one.agg(F.sum(copied("height").cast("double") * copied("width"))).first()[0]
    return max(cells.sparkSession.sparkContext.defaultParallelism, math.ceil((total or 0) / TASK_CELLS))


def with_halo(cells: DataFrame, halo: int, block: int = BLOCK, grids: DataFrame | None = None) -> DataFrame:
    """Copy every cell into each block whose core lies within ``halo`` of it; ``core`` marks the owner.

    ``cells`` needs ``scene_id, row, col, height, width``. The hash shuffle on the
    block is written out so that all later windows reuse it. It has as many partitions as
    the rasters need, so that a task's sorts grow with no raster; their shapes come from
    ``grids`` (``scene_id, height, width``), or else from the cells.
    """

    def owners(position: str, extent: str) -> Column:
        last = F.floor((F.col(extent) - 1) / block)
        low = F.greatest(F.floor((F.col(position) - halo) / block), F.lit(0))
        high = F.least(F.floor((F.col(position) + halo) / block), last)
        return F.explode(F.sequence(low, high))

    spread = cells.withColumn("by", owners("row", "height")).withColumn("bx", owners("col", "width"))
    core = (F.floor(F.col("row") / block) == F.col("by")) & (F.floor(F.col("col") / block) == F.col("bx"))
    return spread.withColumn("core", core).repartition(_block_tasks(cells, halo, block, grids), *_BLOCK_KEYS)


def _axis_sums(df: DataFrame, values: dict[str, str], halves: dict[str, int], nearest: set[str], along: str, extent: str) -> DataFrame:
    """Centred box sums along one axis.

    ``values`` maps result name to input column, ``halves`` to the half width.
    Names in ``nearest`` repeat the raster's edge cell beyond the border; the
    others see nothing there.
    """
    across = "row" if along == "col" else "col"
    order = Window.partitionBy(*_BLOCK_KEYS, across).orderBy(along)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    position, last = F.col(along), F.col(extent) - 1

    edges = {}
    for name in sorted({values[n] for n in values if n in nearest}):
        edges[f"{name}__lo"] = F.max(F.when(position == 0, F.col(name))).over(whole)
        edges[f"{name}__hi"] = F.max(F.when(position == last, F.col(name))).over(whole)
    framed = {
        f"{name}__sum": F.sum(source).over(order.rangeBetween(-halves[name], halves[name]))
        for name, source in values.items()
    }
    staged = df.withColumns({**edges, **framed})

    out = {}
    for name, source in values.items():
        total = F.col(f"{name}__sum")
        if name in nearest:
            h = halves[name]
            total = (
                total
                + F.greatest(F.lit(0), h - position) * F.coalesce(F.col(f"{source}__lo"), F.lit(0))
                + F.greatest(F.lit(0), position + h - last) * F.coalesce(F.col(f"{source}__hi"), F.lit(0))
            )
        out[name] = total
    keep = [c for c in df.columns if c not in out]
    return staged.select(*keep, *[v.alias(k) for k, v in out.items()])


def box_means(df: DataFrame, inputs: dict[str, Column], jobs: Iterable[tuple[str, str, int, str]], min_fraction: float) -> DataFrame:
    """Masked moving means on blocked cells: ``jobs`` are (result, input, width, edge mode).

    Missing cells add nothing to sum or count; the mean is kept where the count
    reaches ``min_fraction`` of the full window. Counts are whole numbers, so the
    threshold is exact.
    """
    jobs = list(jobs)
    base, values, halves, nearest = {}, {}, {}, set()
    for name, column in inputs.items():
        base[f"{name}__v"] = F.coalesce(column.cast("double"), F.lit(0.0))
        base[f"{name}__n"] = F.when(column.isNotNull(), 1).otherwise(0).cast("bigint")
    for result, source, width, mode in jobs:
        check_width(width)
        for part in ("v", "n"):
            key = f"{result}__{part}t"
            values[key], halves[key] = f"{source}__{part}", width // 2
            if mode == "nearest":
                nearest.add(key)
    plain = list(df.columns)
    staged = _axis_sums(df.withColumns(base), values, halves, nearest, "col", "width")
    again = {key: key for key in values}
    staged = _axis_sums(staged, again, halves, nearest, "row", "height")
    means = {}
    for result, _, width, _ in jobs:
        count = F.col(f"{result}__nt")
        enough = (count > 0) & (count >= min_fraction * width * width)
        means[result] = F.when(enough, F.col(f"{result}__vt") / count)
    return staged.select(*plain, *[v.alias(k) for k, v in means.items()])


def masked_mean(cells: DataFrame, value: str, width: int, mode: str = "nearest", min_fraction: float = MIN_VALID_FRACTION, out: str = "mean", block: int = BLOCK, grids: DataFrame | None = None) -> DataFrame:
    """Moving mean over a ``width`` x ``width`` box with missing cells left out.

    ``cells``: one row per grid cell ``scene_id, row, col, height, width`` plus the value.
    """
    if mode not in ("nearest", "constant"):
        raise ValueError("edge mode must be 'nearest' or 'constant'")
    blocked = with_halo(cells, width // 2, block, grids)
    result = box_means(blocked, {"value_in": F.col(value)}, [(out, "value_in", width, mode)], min_fraction)
    return result.filter("core").drop("by", "bx", "core")


def normprod(cells: DataFrame, width: int, min_fraction: float = MIN_VALID_FRACTION, a: str = "a", b: str = "b", out: str = "texture", block: int = BLOCK, grids: DataFrame | None = None) -> DataFrame:
    """Normalised local cross-product of two images.

    mean[(a-ma)(b-mb)] / mean[((sd_a+sd_b)/2)^2] with two nested box filters. The
    numerator sees nothing beyond the raster edge, every other mean repeats the edge
    cell. Both stages work on one blocked copy of the cells.
    """
    blocked = with_halo(cells.select("scene_id", "row", "col", "height", "width", a, b), 2 * (width // 2), block, grids)
    va, vb = F.col(a).cast("double"), F.col(b).cast("double")
    squares = {"va": va, "vb": vb, "va2": va * va, "vb2": vb * vb}
    means = box_means(blocked, squares, [(f"m_{k}", k, width, "nearest") for k in squares], min_fraction)
    # a missing mean must stay missing: greatest() would skip the NULL
    spread = lambda q, m: F.when(q.isNotNull() & m.isNotNull(), F.sqrt(F.greatest(q - m * m, F.lit(0.0))))
    ma, mb = F.col("m_va"), F.col("m_vb")
    deviation = (spread(F.col("m_va2"), ma) + spread(F.col("m_vb2"), mb)) / 2
    inputs = {"cross": (va - ma) * (vb - mb), "power": deviation * deviation}
    ratios = box_means(means, inputs, [("num", "cross", width, "constant"), ("den", "power", width, "nearest")], min_fraction)
    usable = (F.col("den") > 1e-12) & va.isNotNull() & vb.isNotNull()
    texture = F.when(usable, F.col("num") / F.col("den")).alias(out)
    return ratios.filter("core").select("scene_id", "row", "col", a, b, texture)


def halo_pieces(tiles: DataFrame, halo: int, tile: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each tile to itself whole and to its eight neighbours as the strip they need.

    ``tiles``: ``scene_id, ty, tx, row0, col0, h, w, height, width, a, b`` with row-major
    arrays. Only strips travel: at 512-cell tiles and a 32-cell halo about a quarter on
    top of the data instead of nine copies.
    """
    if halo > tile:
        raise ValueError("a tile must be at least as large as the halo")
    offsets = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy in (-1, 0, 1) for dx in (-1, 0, 1)])
    spread = tiles.withColumn("o", F.explode(offsets)).withColumn("oy", F.col("ty") + F.col("o.dy")).withColumn("ox", F.col("tx") + F.col("o.dx"))
    inside = spread.filter(
        (F.col("oy") >= 0)
        & (F.col("ox") >= 0)
        & (F.col("oy") * tile < F.col("height"))
        & (F.col("ox") * tile < F.col("width"))
    )

    def span(step: str, size: str) -> tuple[Column, Column]:
        """First index and length of the strip inside this tile: its near edge for a neighbour, else all."""
        n = F.col(size)
        start = F.when(F.col(step) == 1, F.greatest(n - halo, F.lit(0))).otherwise(F.lit(0))
        return start, F.when(F.col(step) == 0, n).otherwise(F.least(n, F.lit(halo)))

    r0, ph = span("o.dy", "h")
    c0, pw = span("o.dx", "w")
    placed = inside.withColumns({"r0": r0.cast("int"), "ph": ph.cast("int"), "c0": c0.cast("int"), "pw": pw.cast("int")})

    def cut(name: str) -> Column:
        strip = F.expr(f"flatten(transform(sequence(0, ph - 1), i -> slice({name}, (r0 + i) * cast(w as int) + c0 + 1, pw)))")
        return F.when((F.col("o.dy") == 0) & (F.col("o.dx") == 0), F.col(name)).otherwise(strip)

    return placed.select(
        "scene_id",
        F.col("oy").alias("ty"),
        F.col("ox").alias("tx"),
        (F.col("row0") + F.col("r0")).cast("bigint").alias("row0"),
        (F.col("col0") + F.col("c0")).cast("bigint").alias("col0"),
        F.col("ph").alias("h"),
        F.col("pw").alias("w"),
        F.col("height").cast("bigint").alias("height"),
        F.col("width").cast("bigint").alias("width"),
        cut("a").alias("a"),
        cut("b").alias("b"),
        *carry,
    )


def texture_tiles(tiles: DataFrame, widths: Iterable[int], min_fraction: float = MIN_VALID_FRACTION, tile: int = 512, precision: str = "float") -> DataFrame:
    """Multi-scale texture of array tiles: ``scene_id, ty, tx, row0, col0, h, w, t1, t2, t3, ...``.

    Bands are stored in single precision unless ``precision`` is ``double``; the maths is always double.
    """
    widths = tuple(int(w) for w in widths)
    for w in widths:
        check_width(w)
    pieces = halo_pieces(tiles, 2 * (max(widths) // 2), tile)
    scene_type = dict(tiles.dtypes)["scene_id"]
    bands = ", ".join(f"t{k} array<{precision}>" for k in range(1, len(widths) + 1))
    schema = f"scene_id {scene_type}, ty bigint, tx bigint, row0 bigint, col0 bigint, h int, w int, {bands}"
    return pieces.groupBy("scene_id", "ty", "tx").applyInArrow(tile_function(widths, float(min_fraction), int(tile), precision), schema)


def sampled_texture(tiles: DataFrame, widths: Iterable[int], factor: int, min_fraction: float = MIN_VALID_FRACTION, tile: int = 512, units: str = "db") -> DataFrame:
    """Texture at the cells that decimation by ``factor`` keeps: ``scene_id, row, col, height, width, t1, ...`` of the coarse grid.

    ``tiles`` as in ``texture_tiles``, with ``spans``: row spans ``row, lo, hi`` of excluded cells of the tile. Masking,
    decibels and texture happen in one kernel, and no cell that decimation drops ever becomes a row.
    """
    widths = tuple(int(w) for w in widths)
    for w in widths:
        check_width(w)
    pieces = halo_pieces(tiles, 2 * (max(widths) // 2), tile, ("spans",))
    bands = [f"t{k}" for k in range(1, len(widths) + 1)]
    schema = f"scene_id {dict(tiles.dtypes)['scene_id']}, row array<bigint>, col array<bigint>, {', '.join(f'{b} array<double>' for b in bands)}"
    found = pieces.groupBy("scene_id", "ty", "tx").applyInArrow(sampled_function(widths, float(min_fraction), int(tile), int(factor), units), schema)
    return found.select("scene_id", F.inline(F.arrays_zip("row", "col", *bands)))
