"""Masked means and texture."""

from floe.operators.cells import cells_to_tiles, tiles_to_cells
from floe.operators.focal import masked_mean, normprod, texture_tiles
from floe.queries.fixtures import Tables
from floe.queries.registry import query, r4

WIDTHS = (5, 9, 13)
BLOCK = 64


def _offsets(width: int) -> str:
    h = width // 2
    return f"range({-h}, {h + 1}) dr(i), range({-h}, {h + 1}) dc(j)"


def _mean_sql(table: str, value: str, width: int, nearest: bool, fraction: float = 0.8) -> str:
    """Brute force: every cell against every offset of its window."""
    n = "(SELECT max(row) AS h, max(col) AS w FROM fx_grid) n"
    if nearest:
        match = "g.row = least(greatest(c.row + dr.i, 0), n.h) AND g.col = least(greatest(c.col + dc.j, 0), n.w)"
    else:
        match = "g.row = c.row + dr.i AND g.col = c.col + dc.j"
    return (
        f"SELECT c.row, c.col, CASE WHEN count(g.{value}) > 0 AND count(g.{value}) >= {fraction} * {width * width} THEN sum(g.{value}) / count(g.{value}) END AS m "
        f"FROM (SELECT c.row, c.col, dr.i, dc.j FROM fx_grid c, {_offsets(width)}) c0 "
    ).replace("c0", "q").replace("SELECT c.row, c.col, CASE", "SELECT q.row, q.col, CASE") + (
        f"JOIN {n} ON true JOIN {table} g ON " + match.replace("c.row + dr.i", "q.row + q.i").replace("c.col + dc.j", "q.col + q.j") + " GROUP BY q.row, q.col"
    )


@query(
    "w1_masked_mean",
    f"""SELECT g.row, g.col, round(a.m, 6) AS nearest_5, round(b.m, 6) AS constant_9 FROM fx_grid g
LEFT JOIN ({_mean_sql('fx_grid', 'a', 5, True)}) a ON a.row = g.row AND a.col = g.col
LEFT JOIN ({_mean_sql('fx_grid', 'a', 9, False)}) b ON b.row = g.row AND b.col = g.col""",
)
def w1(t: Tables):
    near = masked_mean(t.raster(), "a", 5, "nearest", out="nearest_5", block=BLOCK, grids=t.grid()).select("scene_id", "row", "col", "nearest_5")
    none = masked_mean(t.raster(), "a", 9, "constant", out="constant_9", block=BLOCK, grids=t.grid()).select("scene_id", "row", "col", "constant_9")
    both = near.join(none, ["scene_id", "row", "col"])
    return both.select("row", "col", r4("nearest_5", 6).alias("nearest_5"), r4("constant_9", 6).alias("constant_9"))


def _texture_sql(width: int) -> str:
    """NormProd at one width from brute-force means in two stages."""
    k = width
    first = ", ".join(
        f"{name}{k} AS MATERIALIZED ({_mean_sql('fx_sq', column, width, True)})"
        for name, column in (("ma", "a"), ("mb", "b"), ("qa", "a2"), ("qb", "b2"))
    )
    stage = f"""st{k} AS MATERIALIZED (SELECT g.row, g.col, (g.a - ma.m) * (g.b - mb.m) AS cross_, 
  pow((sqrt(CASE WHEN qa.m - ma.m * ma.m < 0 THEN 0 ELSE qa.m - ma.m * ma.m END) + sqrt(CASE WHEN qb.m - mb.m * mb.m < 0 THEN 0 ELSE qb.m - mb.m * mb.m END)) / 2, 2) AS power_
  FROM fx_grid g LEFT JOIN ma{k} ma USING (row, col) LEFT JOIN mb{k} mb USING (row, col) LEFT JOIN qa{k} qa USING (row, col) LEFT JOIN qb{k} qb USING (row, col))"""
    second = f"""num{k} AS MATERIALIZED ({_mean_sql(f'st{k}', 'cross_', width, False)}), den{k} AS MATERIALIZED ({_mean_sql(f'st{k}', 'power_', width, True)})"""
    return f"{first}, {stage}, {second}"


def _bands(count: int) -> str:
    return ", ".join(
        f"round(CASE WHEN d{i}.m > 1e-12 AND g.a IS NOT NULL AND g.b IS NOT NULL THEN n{i}.m / d{i}.m END, 6) AS t{i}" for i in range(1, count + 1)
    )


def _textures(widths: tuple[int, ...]) -> str:
    return (
        "WITH fx_sq AS (SELECT row, col, a, b, a * a AS a2, b * b AS b2 FROM fx_grid), "
        + ", ".join(_texture_sql(w) for w in widths)
        + f" SELECT g.row, g.col, {_bands(len(widths))} FROM fx_grid g "
        + " ".join(f"LEFT JOIN num{w} n{i} USING (row, col) LEFT JOIN den{w} d{i} USING (row, col)" for i, w in enumerate(widths, 1))
    )


@query("w2_normprod", _textures((9,)))
def w2(t: Tables):
    cells = normprod(t.raster(), 9, out="t1", block=BLOCK, grids=t.grid())
    return cells.select("row", "col", r4("t1", 6).alias("t1"))


def texture_cells(t: Tables, precision: str = "float"):
    """Texture of the raster pair by the tile route, as cells."""
    tiles = cells_to_tiles(t.raster(), BLOCK, ["a", "b"])
    return tiles_to_cells(texture_tiles(tiles, WIDTHS, tile=BLOCK, precision=precision), ["t1", "t2", "t3"])


@query("w3_texture_tiles", _textures(WIDTHS))
def w3(t: Tables):
    return texture_cells(t, "double").select("row", "col", *[r4(f"t{k}", 6).alias(f"t{k}") for k in (1, 2, 3)])
