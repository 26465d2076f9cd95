"""Boxes of points on grids: runs in rows, joined to the runs of the rows after them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.storage import fresh_folder
from .audit import islands
from .graph import components

#: Runs meet in tiles of 2**TILE_BITS rows and columns, so a tile has a bounded number of them.
TILE_BITS = 6
TILE = 1 << TILE_BITS


def tiled(runs: DataFrame, grid: Sequence[str], rows_apart: int, slack: int) -> DataFrame:
    """(grid, tile_y, tile_x, runs): the runs of each tile, and those that may be next to one of its runs.

    ``runs`` has grid, y, start and end. A run is in each tile that its reach touches, from its own
    row to ``rows_apart`` rows below and ``slack`` columns to either side.
    """
    tiles = lambda first, last: F.explode(F.sequence(F.shiftright(first, TILE_BITS), F.shiftright(last, TILE_BITS)))
    dealt = runs.select("*", tiles(F.col("y"), F.col("y") + rows_apart).alias("tile_y"))
    dealt = dealt.select("*", tiles(F.col("start") - slack, F.col("end") + slack).alias("tile_x"))
    return dealt.groupBy(*grid, "tile_y", "tile_x").agg(F.collect_list(F.struct("y", "start", "end")).alias("runs"))


def parts(tiles: DataFrame, grid: Sequence[str], rows_apart: int, slack: int) -> DataFrame:
    """What hangs together within each tile: grid, tile_y, tile_x, part (its number there), box, n_runs and shared.

    A run counts in ``n_runs`` of the tile that it begins in alone; ``shared`` has the (y, start) of
    the runs that are in other tiles too.
    """
    height, width = TILE + 2 * rows_apart, TILE + 2 * slack + 2
    keys = [f for f in tiles.schema.fields if f.name != "runs"]
    shared = T.ArrayType(T.StructType([T.StructField("y", T.LongType()), T.StructField("start", T.LongType())]))
    schema = T.StructType(keys + [T.StructField(c, T.LongType()) for c in ("part", "left", "right", "top", "bottom", "n_runs")] + [T.StructField("shared", shared)])

    def found(batches: Iterable):
        import numpy as np
        import pyarrow as pa

        def within(batch):
            lists = batch.column("runs")
            flat, first = lists.flatten(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            y, start, end = (flat.field(c).to_numpy() for c in ("y", "start", "end"))
            tile = np.repeat(np.arange(len(lists)), np.diff(first))
            tile_y, tile_x = (batch.column(c).to_numpy()[tile] for c in ("tile_y", "tile_x"))
            # Places in the tile; beyond its reach they need no telling apart, so that keys stay small.
            row = tile * height + y - (tile_y << TILE_BITS) + rows_apart
            place = lambda x, row: row * width + np.clip(x - (tile_x << TILE_BITS) + slack + 1, 0, width - 1)
            order = np.argsort(place(start, row), kind="stable")
            y, start, end, tile_y, tile_x, row = (v[order] for v in (y, start, end, tile_y, tile_x, row))
            starts, ends = place(start, row), place(end, row)

            # In each of the rows below, a run meets runs that stand side by side.
            pairs = []
            for apart in range(1, rows_apart + 1):
                low = np.searchsorted(ends, place(start - slack, row + apart), "left")
                n = np.maximum(np.searchsorted(starts, place(end + slack, row + apart), "right") - low, 0)
                pairs.append((np.repeat(np.arange(len(row)), n), np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)))
            a, b = (np.concatenate(side) for side in zip(*pairs)) if pairs else (np.arange(0), np.arange(0))

            # The least run within reach: roots take the least root next to them, then pointers jump.
            root = np.arange(len(row))
            while (root[a] != root[b]).any():
                least = np.minimum(root[a], root[b])
                after = root.copy()
                np.minimum.at(after, root[a], least)
                np.minimum.at(after, root[b], least)
                while (after != after[after]).any():
                    after = after[after]
                root = after

            by_root = np.argsort(root, kind="stable")
            at = np.flatnonzero(np.diff(root[by_root], prepend=-1))
            of_root = lambda f, x: f.reduceat(x[by_root], at) if len(at) else x[:0]
            home = ((y >> TILE_BITS) == tile_y) & ((start >> TILE_BITS) == tile_x)
            wide = ((y >> TILE_BITS) != ((y + rows_apart) >> TILE_BITS)) | (((start - slack) >> TILE_BITS) != ((end + slack) >> TILE_BITS))
            told = root[by_root][at]
            out = [told - first[tile[told]], of_root(np.minimum, start), of_root(np.maximum, end), of_root(np.minimum, y), of_root(np.maximum, y), of_root(np.add, home.astype(np.int64))]
            many = by_root[wide[by_root]]
            ends_at = np.concatenate([[0], of_root(np.add, wide.astype(np.int64))]).cumsum().astype(np.int32)
            spots = pa.StructArray.from_arrays([pa.array(y[many]), pa.array(start[many])], ["y", "start"])
            columns = [batch.column(f.name).take(pa.array(tile[told])) for f in keys]
            return pa.RecordBatch.from_arrays(columns + [pa.array(v) for v in out] + [pa.ListArray.from_arrays(pa.array(ends_at), spots)], names=schema.names)

        for batch in batches:
            yield within(batch)

    return tiles.mapInArrow(found, schema)


def boxes(points: DataFrame, grid: Sequence[str], max_gap: int, least_run: int, rows_apart: int, slack: int, least_width: int, most_height: int) -> DataFrame:
    """Boxes around what hangs together in each grid: left, right (exclusive), top, bottom and n_runs.

    ``points`` has grid, x and y, whole numbers; rows with a null are left out. A run is a stretch of
    a row with gaps of at most ``max_gap`` and ``least_run`` columns or more. Runs hang together over
    rows at most ``rows_apart`` from each other and ``slack`` columns more than touching. Boxes
    narrower than ``least_width`` or higher than ``most_height`` (bottom less top) are left out.

    Runs are linked within tiles; only what has a run in several tiles is joined over tables.
    """
    whole = points.select(*grid, F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"))
    whole = whole.where(" AND ".join(f"`{c}` IS NOT NULL" for c in whole.columns))
    runs = islands(whole.distinct(), [*grid, "y"], "x", max_gap, least_run).drop("n")
    found, folder = parts(tiled(runs, grid, rows_apart, slack), grid, rows_apart, slack), fresh_folder(points.sparkSession, "boxes")
    found.write.parquet(folder)
    found = points.sparkSession.read.schema(found.schema).parquet(folder)
    sides = ["left", "right", "top", "bottom", "n_runs"]
    node = F.struct(*grid, "tile_y", "tile_x", "part").alias("node")
    open_ended = found.where(F.size("shared") > 0).select(*grid, node, *sides, "shared")
    held = open_ended.select(*grid, "node", F.explode("shared").alias("run"))
    links = held.join(held.groupBy(*grid, "run").agg(F.min("node").alias("least")), [*grid, "run"]).select("least", "node")
    named = components(open_ended.select("node"), links)
    extent: list[Column] = [F.min("left").alias("left"), F.max("right").alias("right"), F.min("top").alias("top"), F.max("bottom").alias("bottom"), F.sum("n_runs").alias("n_runs")]
    joined = open_ended.join(named, "node").groupBy(*grid, "component").agg(*extent)
    told = found.where(F.size("shared") == 0).select(*grid, *sides).unionByName(joined.select(*grid, *sides))
    return told.where((F.col("right") - F.col("left") >= least_width) & (F.col("bottom") - F.col("top") <= most_height))
