"""Exact k nearest neighbours of every row, without comparing all pairs.

Points are cut into tiles of a bounded number of rows, so a tile is never larger than planned however the data clump.  Where some
axes matter, space is halved along its widest axis again and again at the medians of a bounded sample; a cell that got more rows than a tile is
cut along a space-filling curve.  Where many matter, every point gets further coordinates: its distances to a few pivots, which by the
triangle inequality bound its distance to anything else; points are laid by nearest pivot and distance to it.  A tile answers its own
points first; the distance to the k-th answer then tells which other tiles could hold something nearer, only those are visited, and they
answer with nothing beyond that distance.  They are found by descending a tree of bounds over the tiles, one join a level, so
no table of tiles is sent around whatever their number.  Copies of one vector are thinned to the k + 1 lowest ids beforehand: no
query can need more of them, since ties go to the lowest id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stockyard.operators.ordering import number_rows
from stockyard.workspace import materialize

DIGITS = 6             # distances are compared at this many decimals, ties by id
PIVOTS = 24            # rows whose distances to all others are kept
PIVOT_SAMPLE = 2048    # rows, chosen by the hash of the id, that pivots are taken from
CURVE_AXES = 6         # widest axes that the space-filling curve takes
CELL_AXES = 16         # axes up to which space is halved into cells
CELLS = 4096           # cells at most
CELL_SAMPLE = 32       # sampled rows a cell
FANOUT = 64            # tiles or nodes below a node of the tree
BOXES_PER_TASK = 512
VISITS_PER_TASK = 20_000
_BLOCK = 4_000_000     # distances held at a time inside a task


def wide_axes(low: list[float], high: list[float]) -> list[int]:
    """Axes with a spread that matters, the widest first."""
    spreads = [h - l for l, h in zip(low, high)]
    widest = max(spreads, default=0.0)
    return sorted((i for i, s in enumerate(spreads) if widest > 0 and s * 1024 > widest), key=lambda i: -spreads[i])


def curve_position(axes: list[str], low: list[float], high: list[float]) -> Column:
    """Bit-interleaved cell number; all axes share one cell width, so cells are cubes."""
    used = wide_axes(low, high)[:CURVE_AXES]
    if not used:
        return F.lit(0).cast("bigint")
    widest, bits, terms = high[used[0]] - low[used[0]], min(16, 60 // len(used)), []
    for a, i in enumerate(used):
        cell = f"least({2 ** bits - 1}L, floor(({axes[i]} - {low[i]!r}D) / {widest!r}D * {2 ** bits}))"
        terms += [f"shiftleft(shiftright({cell}, {b}) & 1L, {b * len(used) + a})" for b in range(bits)]
    return F.expr(" | ".join(terms))


def halve(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(axis, edge) of the 2 ** depth - 1 nodes of a tree over the sample: a node halves its rows along the axis of their largest deviation."""
    axis, edge, held = np.zeros(2 ** depth - 1, int), np.full(2 ** depth - 1, np.inf), [sample]
    for node in range(2 ** depth - 1):
        rows = held[node]
        if len(rows) > 1:
            axis[node] = rows.std(axis=0).argmax()
            x = np.sort(rows[:, axis[node]])
            # the cut between two values that is nearest to the middle
            cuts = np.flatnonzero(x[1:] > x[:-1])
            if len(cuts):
                edge[node] = x[cuts[np.abs(cuts + 1 - len(x) / 2).argmin()]]
        below = rows[:, axis[node]] <= edge[node]
        held += [rows[below], rows[~below]]
        held[node] = None
    return axis, edge


def cell_of(x: np.ndarray, axis: np.ndarray, edge: np.ndarray, depth: int) -> np.ndarray:
    """Number of the cell every row falls into; near numbers are near cells."""
    node, rows = np.zeros(len(x), int), np.arange(len(x))
    for _ in range(depth):
        node = 2 * node + 1 + (x[rows, axis[node]] > edge[node])
    return node - (2 ** depth - 1)


def pick_pivots(points: DataFrame, count: int = PIVOTS) -> np.ndarray:
    """Rows far from each other, out of PIVOT_SAMPLE rows chosen by hash: each next one is the farthest from those before."""
    sample = np.array([r["vec"] for r in points.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).select("vec").collect()], float)
    chosen, gap = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
        if gap.max() <= 0:
            break
        chosen.append(int(gap.argmax()))
    return sample[chosen]


def nearest(queries: np.ndarray, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, distance) of the k nearest points per query; equal distances go to the lower position."""
    parts = []
    step = max(1, _BLOCK // max(1, len(points)))
    for start in range(0, len(queries), step):
        block = queries[start:start + step]
        gap = np.zeros((len(block), len(points)))
        for d in range(points.shape[1]):
            gap += (block[:, d, None] - points[None, :, d]) ** 2
        gap = np.round(np.sqrt(gap), DIGITS)
        edge = np.partition(gap, k - 1, axis=1)[:, k - 1] if len(points) > k else np.full(len(block), np.inf)
        q, p = np.nonzero(gap <= edge[:, None])
        dist = gap[q, p]
        order = np.lexsort((p, dist, q))
        q, p, dist = q[order], p[order], dist[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = rank < k
        parts.append((q[keep] + start, p[keep], dist[keep]))
    return tuple(np.concatenate(c) for c in zip(*parts))


def _near(lows: str, highs: str, other_lows: str, other_highs: str, dims: int, radius: str) -> Column:
    """Whether two boxes can hold points within ``radius``: by plain coordinates, and by each pivot alone."""
    gaps = F.transform(F.arrays_zip(F.col(lows).alias("a"), F.col(highs).alias("b"), F.col(other_lows).alias("c"), F.col(other_highs).alias("d")),
                       lambda x: F.greatest(F.lit(0.0), x["c"] - x["b"], x["a"] - x["d"]))
    plain = F.aggregate(F.slice(gaps, 1, dims), F.lit(0.0), lambda s, x: s + x * x)
    return (F.sqrt(plain) <= F.col(radius)) & F.forall(F.slice(gaps, dims + 1, 2 ** 16), lambda x: x <= F.col(radius))


def _bounds(rows: DataFrame, key: str, lows: list[Column], highs: list[Column], *more: Column) -> DataFrame:
    """Lowest and highest coordinates of every ``key`` as arrays."""
    columns = [F.min(c).alias(f"_l{i}") for i, c in enumerate(lows)] + [F.max(c).alias(f"_h{i}") for i, c in enumerate(highs)]
    return rows.groupBy(key).agg(*columns, *more).select(
        key, F.array(*[f"_l{i}" for i in range(len(lows))]).alias("lows"), F.array(*[f"_h{i}" for i in range(len(highs))]).alias("highs"),
        *[c for c in ("radius",) if more])


def _close_tiles(tiles: DataFrame, count: int, dims: int, width: int) -> DataFrame:
    """(tile, other, lows, highs) of every tile that may hold something within ``radius`` of a point of ``tile``, found from the top
    of a tree with FANOUT nodes below each; a level is one join on the node."""
    levels = [tiles.select(F.col("tile").alias("node"), "lows", "highs")]
    while -(-count // FANOUT ** (len(levels) - 1)) > FANOUT:
        below = levels[-1].withColumn("node", F.floor(F.col("node") / FANOUT).cast("int"))
        levels.append(materialize(_bounds(below, "node", [F.col("lows")[i] for i in range(width)], [F.col("highs")[i] for i in range(width)]), "nodes"))
    top = -(-count // FANOUT ** (len(levels) - 1))  # at most FANOUT nodes
    pairs = tiles.select("tile", F.col("lows").alias("_lows"), F.col("highs").alias("_highs"), "radius",
                         F.explode(F.sequence(F.lit(0), F.lit(top - 1))).alias("node"))
    for depth, level in reversed(list(enumerate(levels))):
        pairs = pairs.join(level, "node").where(_near("_lows", "_highs", "lows", "highs", dims, "radius"))
        if depth:
            last = -(-count // FANOUT ** (depth - 1)) - 1
            children = F.sequence(F.col("node") * FANOUT, F.least(F.col("node") * FANOUT + FANOUT - 1, F.lit(last)))
            pairs = pairs.select("tile", "_lows", "_highs", "radius", F.explode(children).alias("node"))
    return pairs.where(F.col("node") != F.col("tile")).select("tile", F.col("node").alias("other"), "lows", "highs")


def _cells(flat: DataFrame, names: list[str], count: int, low: list[float], high: list[float], tile_rows: int) -> tuple[DataFrame, int]:
    """Rows with their ``tile``, and the number of tiles: every cell is cut into as few equal tiles as it needs."""
    depth = max(0, min(CELLS, int(count / tile_rows * 1.4)).bit_length() - 1)
    some = CELL_SAMPLE * 2 ** depth
    picked = flat if count <= some else flat.where(F.pmod(F.xxhash64("id", F.lit("cell")), F.lit(count)) < some)
    axis, edge = halve(picked.select(*names).toPandas().to_numpy(float), depth)  # about CELLS * CELL_SAMPLE rows at most

    def place(batches):
        for pdf in batches:
            yield pdf.assign(cell=cell_of(pdf[names].to_numpy(float), axis, edge, depth).astype("int32"))

    placed = flat.mapInPandas(place, "id string, " + ", ".join(f"{c} double" for c in names) + ", cell int")
    numbered = number_rows(placed.withColumn("_curve", curve_position(names, low, high)), ["cell", "_curve", "id"], "_no")
    sizes = {r["cell"]: (r["first"], r["n"]) for r in numbered.groupBy("cell").agg(
        F.min("_no").alias("first"), F.count(F.lit(1)).alias("n")).collect()}  # one row a cell, CELLS at most
    rows, tiles = [], 0
    for cell, (first, n) in sorted(sizes.items()):
        rows.append((cell, first, n, -(-n // tile_rows), tiles))
        tiles += rows[-1][3]
    table = flat.sparkSession.createDataFrame(rows, "cell int, _first long, _n long, _tiles int, _base int")
    tile = F.col("_base") + F.floor((F.col("_no") - F.col("_first")) * F.col("_tiles") / F.col("_n"))
    return numbered.join(F.broadcast(table), "cell").select("id", *names, tile.cast("int").alias("tile")), tiles


def _by_pivots(points: DataFrame, pivots: np.ndarray, axes: list[str], dims: int, tile_rows: int) -> DataFrame:
    """Rows with their distances to the pivots and their ``tile``, cut along nearest pivot and distance to it."""
    def widen(batches):
        for pdf in batches:
            x = np.stack(pdf["vec"].to_numpy()).astype(float) if len(pdf) else np.zeros((0, dims))
            far = np.sqrt(np.maximum(((x[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2), 0))
            out = pd.DataFrame(np.concatenate([x, far], axis=1), columns=axes)
            out.insert(0, "id", pdf["id"].to_numpy())
            out["cell"] = far.argmin(axis=1).astype("int32") if len(pdf) else np.zeros(0, "int32")
            yield out

    # points come with the vectors of a bounded batch
    schema = "id string, " + ", ".join(f"{c} double" for c in axes) + ", cell int"
    keyed = materialize(points.select("id", "vec").mapInPandas(widen, schema), "flat").withColumn(
        "_far", F.element_at(F.array(*axes[dims:]), F.col("cell") + 1))
    ordered = number_rows(keyed, ["cell", "_far", "id"], "_no")
    return ordered.select("id", *axes, F.floor(F.col("_no") / tile_rows).cast("int").alias("tile"))


class Tiles:
    """``tiled`` (id, coordinates, tile), ``own`` (id, dist, other inside the tile) and ``visits`` (id, coordinates, radius, tile): the other
    tiles each point has to see."""

    def __init__(self, points: DataFrame, k: int, tile_rows: int):
        dims = len(points.select("vec").head()["vec"])
        self.names = names = [f"v{i}" for i in range(dims)]
        flat = points.select("id", *[F.col("vec")[i].alias(c) for i, c in enumerate(names)])
        bounds = list(flat.agg(F.count(F.lit(1)), *[f(c) for c in names for f in (F.min, F.max)]).head())
        low, high = bounds[1::2], bounds[2::2]
        # where few axes matter, boxes of cells are tight and pivots add nothing
        few = len(wide_axes(low, high)) <= CELL_AXES
        pivots = np.zeros((0, dims)) if few else pick_pivots(points)
        axes = names + [f"p{i}" for i in range(len(pivots))]
        width = len(axes)
        if few:
            self.tiled, count = _cells(flat, names, bounds[0], low, high, tile_rows)
        else:
            self.tiled, count = _by_pivots(points, pivots, axes, dims, tile_rows), -(-bounds[0] // tile_rows)

        def inside(pdf: pd.DataFrame) -> pd.DataFrame:
            """Neighbours within the tile, and how far from each point the others can lie."""
            pdf = pdf.sort_values("id", ignore_index=True)
            ids, pts = pdf["id"].to_numpy(), pdf[names].to_numpy()
            q, p, dist = nearest(pts, pts, k)
            radius = np.full(len(pts), np.inf)
            full = np.bincount(q, minlength=len(pts)) == k
            last = np.searchsorted(q, np.arange(len(pts)), side="right") - 1
            # distances are compared when rounded, and pivots' distances have rounding errors of their own
            radius[full] = dist[last[full]] * (1 + 1e-9) + 2 * 10.0 ** -DIGITS
            tile = int(pdf["tile"].iloc[0])
            points = pdf[["id", "tile", *axes]].assign(radius=radius)
            return pd.concat([points, pd.DataFrame({"id": ids[q], "dist": dist, "other": ids[p], "tile": tile})], ignore_index=True)[fields]

        fields = ["id", "tile", *axes, "radius", "dist", "other"]
        first = materialize(self.tiled.groupBy("tile").applyInPandas(
            inside, "id string, tile int, " + ", ".join(f"{c} double" for c in [*axes, "radius", "dist"]) + ", other string"), "first")
        self.own = first.where("other IS NOT NULL").select("id", "dist", "other")
        reach = first.where("other IS NULL").drop("dist", "other")
        columns = [F.col(c) for c in axes]
        tiles = materialize(_bounds(reach, "tile", columns, columns, F.max("radius").alias("radius")), "tiles")
        close = materialize(_close_tiles(tiles, count, dims, width), "close-tiles")

        def ask(pts: pd.DataFrame, boxes: pd.DataFrame) -> pd.DataFrame:
            """Which of the tiles each point has to visit."""
            if pts.empty or boxes.empty:
                return pd.DataFrame({c: [] for c in ["id", *names, "radius", "tile"]})
            x, radius, out = pts[axes].to_numpy(), pts["radius"].to_numpy(), []
            for t, lows, highs in zip(boxes["other"], boxes["lows"], boxes["highs"]):
                gap = np.maximum(0, np.maximum(np.asarray(lows) - x, x - np.asarray(highs)))
                asks = (np.sqrt((gap[:, :dims] ** 2).sum(axis=1)) <= radius) & (gap[:, dims:] <= radius[:, None]).all(axis=1)
                out.append(pts.loc[asks, ["id", *names, "radius"]].assign(tile=t))
            return pd.concat(out, ignore_index=True)

        # a tile with many boxes to look at is split: boxes by number, its points repeated per part
        parts = close.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / BOXES_PER_TASK).cast("int").alias("parts"))
        asking = (reach.join(parts, "tile")
                  .select("tile", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "id", "radius", *axes))
        boxes = close.join(parts, "tile").select("tile", F.pmod(F.col("other"), F.col("parts")).alias("part"), "other", "lows", "highs")
        self.visits = materialize(asking.groupBy("tile", "part").cogroup(boxes.groupBy("tile", "part"))
                                  .applyInPandas(ask, "id string, " + ", ".join(f"{c} double" for c in [*names, "radius"]) + ", tile int"), "visits")


def _search(points: DataFrame, k: int, tile_rows: int) -> DataFrame:
    """(id, dist, other) with the k nearest points of every point, itself included."""
    plan = Tiles(points, k, tile_rows)
    names, visits = plan.names, plan.visits
    # a tile with many visitors is split: visitors by hash, the tile's own rows repeated per part
    parts = visits.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / VISITS_PER_TASK).cast("int").alias("parts"))
    asking = (visits.join(parts, "tile")
              .select("tile", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), "id", "radius", *names))
    hosts = (plan.tiled.join(parts, "tile")
             .select("tile", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "id", *names))

    def visit(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or held.empty:
            return pd.DataFrame({"id": [], "dist": [], "other": []})
        held = held.sort_values("id", ignore_index=True)
        q, p, dist = nearest(asked[names].to_numpy(), held[names].to_numpy(), k)
        near = dist <= asked["radius"].to_numpy()[q]  # the point's own tile has k rows within
        return pd.DataFrame({"id": asked["id"].to_numpy()[q[near]], "dist": dist[near], "other": held["id"].to_numpy()[p[near]]})

    second = (asking.groupBy("tile", "part").cogroup(hosts.groupBy("tile", "part"))
              .applyInPandas(visit, "id string, dist double, other string"))
    every = plan.own.unionByName(second)
    best = W.partitionBy("id").orderBy("dist", "other")
    return every.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k).drop("_r")


def k_nearest(points: DataFrame, k: int = 5, tile_rows: int = 1024) -> DataFrame:
    """(id string, vec array<double>) -> (id, vec, neighbors), nearest first, the row itself left out.

    ``neighbors`` is array<struct<dist,id>>; ids must be unique, vectors of one length and without nulls.
    """
    points = materialize(points.select("id", "vec"), "points")
    if points.isEmpty():
        return points.withColumn("neighbors", F.array().cast("array<struct<dist:double,id:string>>"))
    copies = W.partitionBy("vec").orderBy("id")
    kept = materialize(points.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k + 1)
                       .select("id", "vec", "_copy"), "kept")
    found = materialize(_search(kept.select("id", "vec"), k + 1, tile_rows).groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("dist", F.col("other").alias("id")))).alias("neighbors")), "found")
    answers = kept.join(found, "id").where("_copy = 1").select("vec", F.col("neighbors").alias("_shared"))
    # rows beyond the first k + 1 copies see the first k copies, which is what copy 1 saw
    out = points.join(found, "id", "left").join(answers, "vec")
    others = F.filter(F.coalesce("neighbors", "_shared"), lambda x: x["id"] != F.col("id"))
    return out.select("id", "vec", F.slice(others, 1, k).alias("neighbors"))


def neighbor_rows(found: DataFrame) -> DataFrame:
    """One row per (id, rank) of a :func:`k_nearest` result."""
    return found.select("id", F.posexplode("neighbors").alias("_p", "_n")).select(
        "id", (F.col("_p") + 1).alias("rank"), F.col("_n.id").alias("neighbor_id"), F.col("_n.dist").alias("distance"))
