"""Optical duplicates: copies of one read whose clusters lie beside each other on the flow cell."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from somaloom.operators.coverage import read_rank
from somaloom.session import cut_lineage

KEYS = ("sample_id", "chrom", "pos", "strand")


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of ``n`` numbered cells that each hangs together with, over links ``a`` to ``b``."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _numbers(cells: tuple[np.ndarray, ...], sought: tuple[np.ndarray, ...]) -> np.ndarray:
    """The number of the cell at each sought place (tile, x, y), -1 where there is none."""
    (tile, x, y), n = cells, len(cells[0])
    wide, i = np.unique(np.concatenate([x, sought[1]]), return_inverse=True)
    high, j = np.unique(np.concatenate([y, sought[2]]), return_inverse=True)
    place = (np.concatenate([tile, sought[0]]) * len(wide) + i) * len(high) + j
    order = np.argsort(place[:n])
    found = order[np.minimum(np.searchsorted(place[:n], place[n:], sorter=order), n - 1)]
    return np.where(place[found] == place[n:], found, -1)


def _chains(cells: pa.ListArray, links: pa.ListArray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the cells of many tiles, in a row: the place in its list of the first cell of each one's chain, and whether a corner of it is undecided.

    Cells side by side are linked if the nearest reads of both are near enough across the shared side, as along it no two differ by
    more. Of cells that share a corner, the read nearest to it in each may tell that they are linked, the outermost reads that they
    are not. What lies between is undecided unless other links join the two. ``links`` are links known before: x, y, x, y of each.
    """
    v = {f.name: c.to_numpy(zero_copy_only=False) for f, c in zip(cells.type.value_type, cells.flatten().flatten())}
    sizes, width = np.diff(cells.offsets.to_numpy()), distance + 1
    tile = np.repeat(np.arange(len(cells)), sizes)
    if not len(tile):
        return tile, tile.astype(bool)
    all_cells = tile, v["cx"], v["cy"]
    before = lambda b, a, c: v[f"lo_{c}"][b] - v[f"hi_{c}"][a] <= distance
    sure, unsure = [], []
    for i, j in ((1, 0), (0, 1), (1, 1), (1, -1)):
        b = _numbers(all_cells, (tile, v["cx"] + i, v["cy"] + j))
        a = np.flatnonzero(b >= 0)
        b = b[a]
        if not i or not j:
            linked = before(b, a, "x" if i else "y")
        else:
            kind = "sum" if j == 1 else "dif"
            (sa, xa), (sb, xb) = ((v[f"{side}_{kind}"][k] // width, v[f"{side}_{kind}"][k] % width) for side, k in (("hi", a), ("lo", b)))
            linked = (xb < xa) & (sb - xb < sa - xa if j == 1 else xb - sb > xa - sa)
            open_ = before(b, a, "x") & (before(b, a, "y") if j == 1 else before(a, b, "y")) & ~linked
            unsure.append((a[open_], b[open_]))
        sure.append((a[linked], b[linked]))
    known = links.flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
    owner = np.repeat(np.arange(len(links)), np.diff(links.offsets.to_numpy()) // 4)
    sure.append(tuple(_numbers(all_cells, (owner, known[:, k], known[:, k + 1])) for k in (0, 2)))
    root = _roots(len(tile), *(np.concatenate(side) for side in zip(*sure)))
    undecided = np.zeros(len(tile), bool)
    for a, b in unsure:
        apart = root[a] != root[b]
        undecided[a[apart]] = undecided[b[apart]] = True
    return root - cells.offsets.to_numpy()[:-1][tile] + cells.offsets[0].as_py(), undecided


def _chained(tiles: DataFrame, distance: int) -> DataFrame:
    """Adds to each tile's ``_cells`` and known ``_links`` the ``_chains`` of its cells."""

    @F.arrow_udf("array<struct<root:bigint,undecided:boolean>>")
    def chains(cells: pa.Array, links: pa.Array) -> pa.Array:
        root, undecided = _chains(cells, links, distance)
        found = pa.StructArray.from_arrays([pa.array(root, pa.int64()), pa.array(undecided, pa.bool_())], names=["root", "undecided"])
        first = cells.offsets.to_numpy()
        return pa.ListArray.from_arrays(pa.array(first - first[0], pa.int32()), found)

    return tiles.withColumn("_chains", chains(F.expr("transform(_cells, c -> struct(c.cx, c.cy, c.lo_x, c.hi_x, c.lo_y, c.hi_y, c.lo_sum, c.hi_sum, c.lo_dif, c.hi_dif))"), "_links"))


def _corner_links(points: DataFrame, group: list[str], distance: int) -> DataFrame:
    """Cells that share a corner and hold two clusters within the distance.

    Only the clusters nearest to the shared side can decide, one for each line of pixels, so a cell sends at most
    ``distance + 1`` rows however many reads it holds.
    """
    rows = points.groupBy(*group, "_cx", "_cy", "_y").agg(F.max("_x").alias("_hi"), F.min("_x").alias("_lo"))
    step = F.explode(F.array(F.lit(-1).cast("bigint"), F.lit(1).cast("bigint")))
    near = rows.select(*group, F.col("_cx").alias("_ax"), F.col("_cy").alias("_ay"), F.col("_y").alias("_at"), "_hi", step.alias("_s"))
    near = near.withColumns({"_cx": F.col("_ax") + 1, "_cy": F.col("_ay") + F.col("_s")}).drop("_s")
    met = near.join(rows.drop("_hi"), [*group, "_cx", "_cy"])
    return met.filter((F.abs(F.col("_at") - F.col("_y")) <= distance) & (F.col("_lo") - F.col("_hi") <= distance)).select(*group, "_ax", "_ay", "_cx", "_cy").distinct()


def optical_duplicates(reads: DataFrame, keys: Sequence[str] = KEYS, quality: str = "sum_bq", read_id: str = "read_id",
                       tile: str = "tile", x: str = "x", y: str = "y", distance: int = 100) -> DataFrame:
    """Adds ``is_optical``: all but the best read of each optical cluster of a copy group.

    Two copies on one tile belong together when neither coordinate differs by more than ``distance`` pixels, and
    so do reads joined by a chain of such pairs. Clusters are filed in square cells of ``distance + 1`` pixels:
    reads of one cell always belong together, so chains run over cells, whose number a tile bounds, never over
    pairs of reads. A cell is one row: its outermost reads, those nearest to its corners, its best read. Corners
    that these leave undecided are compared line by line. ``reads`` are scanned twice, the chains are written when
    called. A read with a NULL key, tile or coordinate is no optical duplicate. The best read is chosen as
    by ``mark_duplicates``, so an optical duplicate always is a duplicate there. Coordinates are whole numbers.
    """
    keys = list(keys)
    group = [*keys, tile]
    needed = [*group, x, y]
    cell = lambda c: F.floor(F.col(c).cast("bigint") / (distance + 1)).cast("bigint")
    whole = reads.dropna(subset=needed).withColumns({"_cx": cell(x), "_cy": cell(y)})
    rank = read_rank(reads, quality, read_id)
    points = whole.select(*group, "_cx", "_cy", F.col(x).cast("bigint").alias("_x"), F.col(y).cast("bigint").alias("_y"), rank.alias("_rank"))
    inner = points.withColumns({"_i": F.expr(f"_x - _cx * {distance + 1}"), "_j": F.expr(f"_y - _cy * {distance + 1}")})
    ends = {"x": F.col("_x"), "y": F.col("_y"), "sum": F.expr(f"(_i + _j) * {distance + 1} + _i"), "dif": F.expr(f"(_i - _j) * {distance + 1} + _i")}
    cells = inner.groupBy(*group, "_cx", "_cy").agg(F.min("_rank").alias("_best"), *[f(c).alias(f"{side}_{name}") for name, c in ends.items() for side, f in (("lo", F.min), ("hi", F.max))])
    one = F.struct("_best", F.col("_cx").alias("cx"), F.col("_cy").alias("cy"), *[f"{side}_{name}" for name in ends for side in ("lo", "hi")])
    tiles = cells.groupBy(*group).agg(F.sort_array(F.collect_list(one)).alias("_cells")).withColumn("_links", F.expr("CAST(array() AS array<bigint>)"))
    tiles = cut_lineage(_chained(tiles, distance))
    one = F.explode(F.arrays_zip("_cells", "_chains")).alias("_z")
    corners = cut_lineage(tiles.select(*group, one).filter("_z._chains.undecided").select(*group, F.col("_z._cells.cx").alias("_cx"), F.col("_z._cells.cy").alias("_cy")))
    if not corners.isEmpty():
        links = _corner_links(points.join(corners, [*group, "_cx", "_cy"], "left_semi"), group, distance)
        found = links.groupBy(*group).agg(F.flatten(F.collect_list(F.array("_ax", "_ay", "_cx", "_cy"))).alias("_found"))
        tiles = _chained(tiles.join(found, group, "left").withColumn("_links", F.coalesce("_found", "_links")).drop("_found", "_chains"), distance)
    best = F.transform(F.arrays_zip("_cells", "_chains"), lambda z: F.struct(
        z["_cells"]["cx"].alias("_cx"), z["_cells"]["cy"].alias("_cy"), F.get("_cells", z["_chains"]["root"])["_best"].alias("_best")))
    named = whole.join(tiles.select(*group, F.inline(best)), [*group, "_cx", "_cy"])
    flagged = named.withColumn("is_optical", ~F.col("_best").eqNullSafe(rank)).select(*reads.columns, "is_optical")
    rest = reads.filter(" OR ".join(f"`{c}` IS NULL" for c in needed)).withColumn("is_optical", F.lit(False))
    return flagged.unionByName(rest)


def duplicate_counts(reads: DataFrame, by: str = "sample_id") -> DataFrame:
    """Read counts that ``coverage.dup_metrics`` takes, from ``paired, is_duplicate, is_optical`` of each read."""
    n = lambda cond: F.count_if(F.expr(cond))
    return reads.groupBy(by).agg(
        n("paired").alias("paired_reads"), n("paired AND is_duplicate").alias("dup_pair_reads"), n("paired AND is_optical").alias("optical_pair_reads"),
        n("NOT paired").alias("single_reads"), n("NOT paired AND is_duplicate").alias("dup_single_reads"))
