"""Raster operators over blocks: a row is a tile's raster of a year, its cells in one binary column.

Neighbourhood kernels need whole rasters, which SQL can't give; a block is bounded by the tiling (a 48 km tile has about
2.6 million cells, 10 MB as floats). Kernels that look over years get the blocks of one tile together.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from strandline.functions import kernels

BLOCK = "tile string, year int, y0 int, x0 int, h int, w int, data binary"


def to_blocks(pixels: DataFrame, value: str, by=("tile", "year")) -> DataFrame:
    """Pixel rows (``tile, year, yi, xi``) to blocks of doubles; cells without a row or a value are NaN."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        y0, x0 = int(pdf.yi.min()), int(pdf.xi.min())
        h, w = int(pdf.yi.max()) - y0 + 1, int(pdf.xi.max()) - x0 + 1
        data = np.full((h, w), np.nan)
        data[pdf.yi - y0, pdf.xi - x0] = pdf[value].astype(float)
        return pd.DataFrame([(str(pdf.tile.iloc[0]), int(pdf.year.iloc[0]), y0, x0, h, w, data.tobytes())], columns=[c.split()[0] for c in BLOCK.split(", ")])

    rows = pixels.select(F.col("tile").cast("string").alias("tile"), F.col("year").cast("int").alias("year"), "yi", "xi", F.col(value).cast("double").alias(value))
    return rows.groupBy(*by).applyInPandas(pack, BLOCK)


def array_of(row, data: str = "data") -> np.ndarray:
    return np.frombuffer(getattr(row, data), float).reshape(row.h, row.w)


def to_pixels(blocks: DataFrame, value: str, kind: str = "double") -> DataFrame:
    """Blocks to pixel rows of the cells that are known."""

    def unpack(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                data = array_of(row)
                y, x = np.nonzero(~np.isnan(data))
                yield pd.DataFrame({"tile": row.tile, "year": row.year, "yi": y + row.y0, "xi": x + row.x0, value: data[y, x]})

    out = blocks.mapInPandas(unpack, f"tile string, year int, yi int, xi int, {value} double")
    return out if kind == "double" else out.withColumn(value, F.col(value).cast(kind))


def apply_kernel(blocks: DataFrame, kernel) -> DataFrame:
    """A function of one array, over each block by itself."""

    def run(batches):
        for pdf in batches:
            pdf["data"] = [np.asarray(kernel(array_of(r)), float).tobytes() for r in pdf.itertuples()]
            yield pdf

    return blocks.mapInPandas(run, BLOCK)


def erase_cleaned(obs: DataFrame, column: str, bad: list[str], values: list[str], scene=("tile", "time"), kernel=kernels.cloud_cleanup) -> DataFrame:
    """Observations with NULL ``values`` where the cleaned mask of their scene holds.

    The mask has the cells of a bad category and those without a row; ``kernel`` closes its holes, takes narrow parts away and
    widens the rest. A scene of a tile is one group.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y, x = (pdf.yi - pdf.yi.min()).to_numpy(), (pdf.xi - pdf.xi.min()).to_numpy()
        mask = np.ones((y.max() + 1, x.max() + 1), bool)
        mask[y, x] = pdf[column].isin(bad).to_numpy()
        pdf.loc[kernel(mask)[y, x], values] = np.nan
        return pdf

    return obs.groupBy(*scene).applyInPandas(run, _with_nulls(obs.schema, values))


def _with_nulls(schema: StructType, names: list[str]) -> StructType:
    return StructType([StructField(f.name, f.dataType, f.nullable or f.name in names) for f in schema.fields])


def erase_shadow(obs: DataFrame, dem: DataFrame, sun: DataFrame, values: list[str], threshold: float = 0.5, radius: int = 1) -> DataFrame:
    """Observations with NULL ``values`` in the terrain's shadow.

    ``dem`` has the heights of cells (``tile, yi, xi, elevation``, in cell units), ``sun`` its place at each scene (``tile, time, sun_elevation,
    sun_azimuth``). Cells without a height count as 0; scenes without a sun stay as they are.
    """
    rows = obs.join(dem.select("tile", "yi", "xi", F.col("elevation").alias("_h")), ["tile", "yi", "xi"], "left")
    rows = rows.join(sun.select("tile", "time", F.col("sun_elevation").alias("_up"), F.col("sun_azimuth").alias("_turn")), ["tile", "time"], "left")
    rows = rows.select(*obs.columns, "_h", "_up", "_turn")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        up, turn = pdf["_up"].iloc[0], pdf["_turn"].iloc[0]
        y, x = (pdf.yi - pdf.yi.min()).to_numpy(), (pdf.xi - pdf.xi.min()).to_numpy()
        heights = np.zeros((y.max() + 1, x.max() + 1))
        heights[y, x] = pdf["_h"].fillna(0.0)
        if not (np.isnan(up) or np.isnan(turn)) and min(heights.shape) > 1:
            pdf.loc[kernels.terrain_shadow(heights, up, turn, threshold, radius)[y, x], values] = np.nan
        return pdf.drop(columns=["_h", "_up", "_turn"])

    return rows.groupBy("tile", "time").applyInPandas(run, _with_nulls(obs.schema, values))


def apply_over_years(blocks: DataFrame, kernel) -> DataFrame:
    """A function of a tile's (year, y, x) array to one of the same shape; years are sorted, cells aligned."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cube, out = cube_of(pdf)
        out["data"] = [np.asarray(a, float).tobytes() for a in kernel(cube)]
        return out

    return blocks.groupBy("tile").applyInPandas(run, BLOCK)


def cube_of(pdf: pd.DataFrame, data: str = "data") -> tuple[np.ndarray, pd.DataFrame]:
    """The blocks of one tile as an array, and their rows on the common extent."""
    pdf = pdf.sort_values("year").reset_index(drop=True)
    y0, x0 = int(pdf.y0.min()), int(pdf.x0.min())
    h, w = int((pdf.y0 + pdf.h).max()) - y0, int((pdf.x0 + pdf.w).max()) - x0
    cube = np.full((len(pdf), h, w), np.nan)
    for i, r in enumerate(pdf.itertuples()):
        cube[i, r.y0 - y0 : r.y0 - y0 + r.h, r.x0 - x0 : r.x0 - x0 + r.w] = array_of(r, data)
    return cube, pdf.assign(y0=y0, x0=x0, h=h, w=w)


def coastal_index(index: np.ndarray, ocean: np.ndarray | None = None, threshold: float = 0.0, buffer: int = 33, edits: np.ndarray | None = None, seed: int = 20) -> dict:
    """From a (year, y, x) water index to the index near the ocean's shore, with the masks on the way.

    Land that stands alone in its year becomes unknown; unknown counts as land when a year's ocean is traced, and is left
    out of the all-time shares. ``ocean`` are cells that are surely ocean; without it, those far from any all-time land.
    ``edits`` overrides the coastal mask where it is not 0 (1 coastal, 2 inland).
    """
    known = ~np.isnan(index)
    land = known & (index < threshold)
    steady = kernels.temporal_mask(land)
    valid = known & steady
    n = valid.sum(axis=0)
    with np.errstate(invalid="ignore", divide="ignore"):
        share = np.where(n > 0, (land & valid).sum(axis=0) / n, np.nan)
        land20, land80 = share > 0.2, share > 0.8
    rivers, banks = kernels.river_mask(land80)
    if ocean is None:
        ocean = kernels.erode(~land20, seed)
    coast = kernels.coastal_mask(~(land20 | rivers), ocean, buffer)
    coast[banks] = 2
    if edits is not None:
        coast = np.where(edits == 0, coast, edits)
    # each year's ocean: water of the year, unknown cells and inland apart
    water = valid & ~land & (coast != 2)
    sea = np.stack([kernels.ocean_mask(w, ocean, 3) for w in water])
    masked = np.where(steady & sea & (coast == 1), index, np.nan)
    return {"masked": masked, "land20": land20, "land80": land80, "rivers": banks, "temporal": steady, "annual": sea, "coastal": coast}


OCEAN, EDITS = -1, -2


def coastal_blocks(blocks: DataFrame, threshold: float = 0.0, buffer: int = 33, seed: int = 20, ocean: DataFrame | None = None, edits: DataFrame | None = None) -> DataFrame:
    """``coastal_index`` over the blocks of each tile.

    ``ocean`` has the cells that are ocean for sure (``tile, yi, xi``) before they are eroded by 10 cells; ``edits`` cells with a
    ``type`` of 1 (coastal) or 2 (inland). They travel with the tile's blocks as rasters of years that don't exist.
    """
    rows = blocks
    if ocean is not None:
        rows = rows.unionByName(to_blocks(ocean.withColumns({"year": F.lit(OCEAN), "_v": F.lit(1.0)}), "_v"))
    if edits is not None:
        rows = rows.unionByName(to_blocks(edits.withColumn("year", F.lit(EDITS)), "type"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cube, out = cube_of(pdf)
        real = (out.year >= 0).to_numpy()

        def layer(year):
            at = np.flatnonzero(out.year == year)
            return np.nan_to_num(cube[at[0]]) if len(at) else None

        sea, changes = layer(OCEAN), layer(EDITS)
        if not real.any():
            return out[real]
        sea = None if sea is None else kernels.erode(sea > 0, 10)
        masked = coastal_index(cube[real], sea, threshold, buffer, None if changes is None else changes.astype(int), seed)["masked"]
        out = out[real].copy()
        out["data"] = [a.tobytes() for a in masked]
        return out

    return rows.groupBy("tile").applyInPandas(run, BLOCK)


def certainty_blocks(composites: DataFrame, sieve_size: int = 128, widen: int = 3) -> DataFrame:
    """Blocks of certainty classes from composites (``count``, ``stdev``), cleaned and widened; year by year."""
    n, spread = to_blocks(composites, "count"), to_blocks(composites, "stdev").select("tile", "year", F.col("data").alias("spread"))

    def run(batches):
        for pdf in batches:
            pdf["data"] = [kernels.certainty(array_of(r), array_of(r, "spread"), sieve_size, widen).astype(float).tobytes() for r in pdf.itertuples()]
            yield pdf.drop(columns="spread")

    return n.join(spread, ["tile", "year"]).mapInPandas(run, BLOCK)


def shorelines(blocks: DataFrame, level: float = 0.0, least: int = 10) -> DataFrame:
    """``tile, year, line, ord, y, x``: vertices of the contours of each block, in cell units of the tile."""

    def run(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                lines = kernels.chains(kernels.contour_segments(array_of(row), level), least)
                for k, line in enumerate(lines):
                    yield pd.DataFrame({"tile": row.tile, "year": row.year, "line": k, "ord": np.arange(len(line)), "y": line[:, 0] + row.y0, "x": line[:, 1] + row.x0})

    return blocks.mapInPandas(run, "tile string, year int, line int, ord int, y double, x double")


def contour_segments(pixels: DataFrame, value: str, keys, level: float = 0.0) -> DataFrame:
    """Marching squares without saddles' special case in relational form: the crossings on the edges of squares.

    Each cell joins its right and lower neighbours by window functions along rows and columns; crossings are interpolated:
    ``yi, xi`` of the cell, ``axis`` and the crossing's ``cy, cx``.
    """
    from pyspark.sql import Window

    def ahead(by, axis):
        w = Window.partitionBy(*keys, by).orderBy(axis)
        follows = F.lead(axis).over(w) == F.col(axis) + 1
        return F.when(follows, F.lead(value).over(w))

    rows = pixels.withColumns({"_right": ahead("yi", "xi"), "_down": ahead("xi", "yi")})
    sides = F.array(F.struct(F.lit("x").alias("axis"), F.col("_right").alias("v")), F.struct(F.lit("y").alias("axis"), F.col("_down").alias("v")))
    edges = rows.select(*keys, "yi", "xi", F.col(value).alias("_a"), F.inline(sides))
    edges = edges.where((F.col("_a") > level) != (F.col("v") > level))
    t = F.try_divide(level - F.col("_a"), F.col("v") - F.col("_a"))
    along_x = F.col("axis") == "x"
    return edges.select(
        *keys, "yi", "xi", "axis",
        (F.col("yi") + F.when(along_x, 0.0).otherwise(t)).alias("cy"), (F.col("xi") + F.when(along_x, t).otherwise(0.0)).alias("cx"),
    )


def dilate_cells(cells: DataFrame, keys, radius: int) -> DataFrame:
    """Binary dilation of sparse cells (``yi, xi``) in relational form: each cell gives its disc, doubles go."""
    disc = [(dy, dx) for dy in range(-radius, radius + 1) for dx in range(-radius, radius + 1) if dy * dy + dx * dx <= radius * radius]
    moves = F.explode(F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in disc)))
    out = cells.select(*keys, "yi", "xi", moves.alias("_m"))
    return out.select(*keys, (F.col("yi") + F.col("_m.dy")).alias("yi"), (F.col("xi") + F.col("_m.dx")).alias("xi")).distinct()
