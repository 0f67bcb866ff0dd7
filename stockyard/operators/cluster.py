"""Clustering and principal components."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.functions.scalars import distance, exact_avg, hash_int, keyed, split_places
from stockyard.operators.features import enrich_numeric, fill_zero
from stockyard.schema import NUMERIC_COLUMNS
from stockyard.workspace import materialize


def centroid_array(centroids: DataFrame) -> Column:
    """k rows (cluster, vec) as one array-valued scalar subquery."""
    rows = centroids.agg(F.array_sort(F.collect_list(F.struct("cluster", "vec"))).alias("c"))
    return rows.scalar()


def assign_nearest(points: DataFrame, centroids: DataFrame, digits: int = 9) -> DataFrame:
    """Add cluster and distance of the nearest centroid; the lowest cluster id wins a tie."""
    gaps = F.transform(F.col("_c"), lambda c: F.struct(
        F.round(distance(F.col("vec"), c["vec"]), digits).alias("distance"), c["cluster"].alias("cluster")))
    return (points.withColumn("_c", centroid_array(centroids)).withColumn("_m", F.array_min(gaps))
            .withColumns({"cluster": F.col("_m.cluster"), "distance": F.col("_m.distance")}).drop("_c", "_m"))


def update_centroids(assigned: DataFrame, previous: DataFrame, dims: int) -> DataFrame:
    """Mean vector per cluster; a cluster without points keeps its centroid."""
    means = assigned.groupBy("cluster").agg(*[F.avg(F.col("vec")[i]).alias(f"_{i}") for i in range(dims)])
    means = means.select("cluster", F.array(*[f"_{i}" for i in range(dims)]).alias("_new"))
    return previous.join(means, "cluster", "left").select("cluster", F.coalesce("_new", "vec").alias("vec"))


def lloyd_steps(points: DataFrame, seeds: DataFrame, dims: int, steps: int) -> DataFrame:
    """Centroids after a fixed number of Lloyd steps.

    The k centroids are written after every step, so each step reads the points once.
    """
    centroids = materialize(seeds, "centroids")
    for _ in range(steps):
        moved = update_centroids(assign_nearest(points, centroids), centroids, dims)
        centroids = materialize(moved, "centroids")
    return centroids


def _assembled(df: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str]]:
    columns = [c for c in columns if c in df.columns]
    return fill_zero(df, columns), columns


def _nearest(df: DataFrame, names: list[str], centers: list[list[float]], output: str, digits: int = 9) -> DataFrame:
    """Add the number of the nearest centre by rounded distance; the lowest wins a tie.

    Rounding is dear, and only matters where two centres are about as near: elsewhere the plain distances decide.  The centres are a scalar
    subquery and no literals, so that all passes run the same compiled code.
    """
    table = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centers])
    df = df.withColumn("_c", df.sparkSession.range(0, 1, 1, 1).select(table.alias("c")).scalar())
    gaps = [f"_gap{i}" for i in range(len(centers))]
    near = df.withColumns({g: F.sqrt(sum(((F.col(n) - F.col("_c")[i][j]) * (F.col(n) - F.col("_c")[i][j]) for j, n in enumerate(names)), F.lit(0.0)))
                           for i, g in enumerate(gaps)}).drop("_c")
    rounded = F.array_min(F.array(*[F.struct(F.round(g, digits).alias("d"), F.lit(i).alias("cluster")) for i, g in enumerate(gaps)]))["cluster"]
    if len(centers) == 1:
        return near.withColumn(output, F.lit(0)).drop(*gaps)
    # null where a gap is: then the rounded ones decide, as for ties
    near = near.withColumn("_reach", F.least(*gaps) + F.lit(3 * 10.0 ** -digits))
    alone = sum(((F.col(g) <= F.col("_reach")).cast("int") for g in gaps[1:]), (F.col(gaps[0]) <= F.col("_reach")).cast("int")) == 1
    first = F.coalesce(*[F.when(F.col(g) <= F.col("_reach"), i) for i, g in enumerate(gaps)])
    return near.withColumn(output, F.when(alone, first).otherwise(rounded)).drop(*gaps, "_reach")


def lloyd(df: DataFrame, columns: list[str], key: str | None = None, k: int = 4, max_iter: int = 50, seed: int = 42,
          output: str = "cluster") -> DataFrame:
    """Labels by Lloyd's steps from k rows as seeds (smallest hashes of ``key``), until no label changes or ``max_iter`` labellings are done.

    A step is one pass that sends one row per cluster: the exact mean of its points and the sums of two hashes of (point, label).  If these
    fingerprints are those of the step before, so are the labels, and no row's label has to be kept to find out.  As all labels start at 0, a first step
    that puts everything into cluster 0 ends it too.  A cluster that loses all points keeps its centre.
    """
    names = [f"_x{i}" for i in range(len(columns))]
    named = key or F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    points = materialize(df.select((F.col(named) if key else named).alias("_key"), *[F.col(c).cast("double").alias(n) for c, n in zip(columns, names)],
                                   *[part.alias(f"{n}_{p}") for c, n in zip(columns, names) for p, part in zip("wp", split_places(F.col(c).cast("double"), 12))])
                         .withColumn("_hash", F.xxhash64("_key")), "points")
    rows = points.orderBy(hash_int(keyed("_key", seed)), "_key").limit(k).select(*names).collect()  # k rows
    centers, before = [[float(v) for v in r] for r in rows], None
    points = points.drop("_key")
    mark = F.xxhash64("_hash", "_label")
    for step in range(max_iter):
        if not centers:
            break
        sums = _nearest(points, names, centers, "_label").groupBy("_label").agg(
            *[exact_avg((F.col(f"{n}_w"), F.col(f"{n}_p")), 12).alias(n) for n in names], F.count(F.lit(1)).alias("_n"),
            *[F.sum(F.shiftrightunsigned(mark, at).bitwiseAND(F.lit((1 << 24) - 1))).alias(f"_f{at}") for at in (0, 32)]).collect()  # k rows
        now = sorted((r["_label"], r["_n"], r["_f0"], r["_f32"]) for r in sums)
        if now == before or (step == 0 and [r[0] for r in now] == [0]) or step == max_iter - 1:
            break
        before = now
        for r in sums:
            centers[r["_label"]] = [r[n] for n in names]
    if not centers:
        return df.withColumn(output, F.lit(None).cast("int"))
    wide = df.withColumns({n: F.col(c).cast("double") for c, n in zip(columns, names)})
    return _nearest(wide, names, centers, "_label").withColumn(output, F.col("_label").cast("int")).drop(*names, "_label")


def standardised(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``_std_<column>``: gap to the mean in sample deviations; 0 where all values are equal."""
    stats = df.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("d", F.stddev))]).first()
    return df.withColumns({f"_std_{c}": (F.col(c) - F.lit(stats[f"m_{i}"])) / F.lit(stats[f"d_{i}"]) if stats[f"d_{i}"] else F.lit(0.0)
                           for i, c in enumerate(columns)})


def market_clusters(df: DataFrame, columns: list[str] | None = None, k: int = 4, scale: bool = False,
                    seed: int = 42, output: str = "market_cluster", max_iter: int = 50, key: str | None = None) -> DataFrame:
    """Lloyd's labels on the raw (default) or standardised columns."""
    filled, columns = _assembled(df, columns or NUMERIC_COLUMNS)
    if not scale:
        return lloyd(filled, columns, key, k, max_iter, seed, output)
    wide = [f"_std_{c}" for c in columns]
    return lloyd(standardised(filled, columns), wide, key, k, max_iter, seed, output).drop(*wide)


def market_segments(df: DataFrame, columns: list[str], k: int = 4, seed: int = 42, key: str | None = None) -> DataFrame:
    return market_clusters(df, columns, k, scale=True, seed=seed, output="market_segment", key=key)


def fit_pca(df: DataFrame, columns: list[str], k: int):
    filled, columns = _assembled(df, columns)
    assembled = VectorAssembler(inputCols=columns, outputCol="_raw").transform(filled)
    return PCA(k=min(k, len(columns)), inputCol="_raw", outputCol="_pca").fit(assembled), columns


def oriented_loadings(pc) -> list[list[float]]:
    """Loadings (features x components), each component turned so its largest loading is positive."""
    m = pc.toArray().copy()
    for j in range(m.shape[1]):
        if m[abs(m[:, j]).argmax(), j] < 0:
            m[:, j] = -m[:, j]
    return m.tolist()


def pca_components(df: DataFrame, columns: list[str] | None = None, k: int = 3) -> DataFrame:
    """(feature, component, loading, explained_variance) from the centred covariance."""
    model, columns = fit_pca(df, columns or NUMERIC_COLUMNS, k)
    rows = [(c, j, float(v), float(model.explainedVariance[j]))
            for c, row in zip(columns, oriented_loadings(model.pc)) for j, v in enumerate(row)]
    return df.sparkSession.createDataFrame(
        rows, "feature string, component int, loading double, explained_variance double")


def project(df: DataFrame, columns: list[str], loadings: list[list[float]], prefix: str = "pca_") -> DataFrame:
    """Uncentred columns times loadings (features x components)."""
    return df.withColumns({
        f"{prefix}{j}": sum((F.col(c) * F.lit(float(w[j])) for c, w in zip(columns, loadings)), F.lit(0.0))
        for j in range(len(loadings[0]))})


def enriched_features(df: DataFrame, k: int = 4, components: int = 3, scale: bool = False, seed: int = 42,
                      key: str | None = None) -> DataFrame:
    """z-scores and signed logs, market cluster, and projections on the first components."""
    available = [c for c in NUMERIC_COLUMNS if c in df.columns]
    clustered = market_clusters(enrich_numeric(df, available), available, k, scale, seed, key=key)
    model, _ = fit_pca(df, available, components)
    return project(clustered, available, oriented_loadings(model.pc))


def covariance(df: DataFrame, columns: list[str]) -> DataFrame:
    """Sample covariance of every pair of columns as rows (a, b, cov), one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.covar_samp(a, b).alias(f"c{n}") for n, (a, b) in enumerate(pairs)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{n}").alias("cov"))
        for n, (a, b) in enumerate(pairs)])).alias("r")).select("r.*")


def damage_clusters(df: DataFrame, vec: str = "vec", k: int = 4, components: int = 5, seed: int = 42):
    """PCA then k-means on vectors: labelled rows, loadings, explained variance, centres."""
    points = df.withColumn("_v", array_to_vector(F.col(vec).cast("array<double>")))
    width = len(points.select(vec).head()[0])
    pca = PCA(k=min(components, width), inputCol="_v", outputCol="_p").fit(points)
    # the published projection is centred; a shift does not change k-means, so it is left out
    projected = pca.transform(points)
    model = KMeans(k=k, seed=seed, featuresCol="_p", predictionCol="cluster").fit(projected)
    labelled = model.transform(projected).withColumn("components", vector_to_array("_p")).drop("_v", "_p")
    return {"labels": labelled, "loadings": oriented_loadings(pca.pc),
            "explained_variance": [float(v) for v in pca.explainedVariance],
            "centers": [c.tolist() for c in model.clusterCenters()]}
