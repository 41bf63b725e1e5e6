"""Clustering of aligned metric rows.

Centres are few (k is half the root of the number of points), so all groups'
and runs' centres are gathered, their number checked against ``MOST_CENTERS``
first, and broadcast. Points then pass through one blocked kernel: per Arrow
batch and group, a matrix product bounds the squared distances of a block of
points to the centres of all runs. Where one centre is nearer than the product's
rounding can be wrong, it is the nearest; the few points left are compared
feature by feature. No point carries centres and no point is copied for
another run. ``laid_out`` writes points by ranges of their group, so that a
batch holds few groups while a hot group is still spread over tasks. A Lloyd
step sums up per task and centre what lies nearest and merges these partial
sums; it reads the points once for all groups and runs, and the loop ends at
the fixed point. As k grows with the root of a group's points, a step compares
n * k = n ** 1.5 / 2 pairs a run.

Beyond ``MOST_CENTERS`` the centres stay a table: points are joined, salted, to
their group's array of centres.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import spread_over, stage

FEATURES = ["filewrites", "filereads", "CPU", "diskIOBW", "net_bytes"]

#: Centres of all groups and runs that are broadcast (80 MB of five features).
MOST_CENTERS = 2_000_000
_CELLS = 1 << 18  # distances held at once (2 MB, a core's cache)
_SLACK = 1e-12    # of the squared lengths: far above what rounding adds to a product
_BOUND = 1e100    # larger numbers are compared feature by feature
_SALTS = 32


def feature_rows(aligned: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Drop the time, keep rows whose features are all numbers (others are
    rejects, counted apart by ``feature_rejects``)."""
    ok = F.lit(True)
    for c in features:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(c)
    return aligned.where(ok)


def feature_rejects(aligned: DataFrame, group: Sequence[str], features: Sequence[str] = FEATURES) -> DataFrame:
    bad = F.lit(False)
    for c in features:
        bad = bad | F.col(c).isNull() | F.isnan(c)
    return aligned.groupBy(*group).agg(F.count_if(bad).alias("n_rejected"))


def pick_k(n: Column, floor_k: int = 2) -> Column:
    """``int(sqrt(n) / 2)``, at least ``floor_k`` (k = 1 is refused by KMeans)."""
    return F.greatest(F.lit(floor_k), F.floor(F.sqrt(n) / 2).cast("int"))


def pick_k_value(n: int, floor_k: int = 2) -> int:
    return max(floor_k, int(math.sqrt(float(n)) / 2))


def start_centers(points: DataFrame, group: Sequence[str], t: Column, tie: str, runs: int | None = None,
                  features: Sequence[str] = FEATURES) -> DataFrame:
    """Start centres for k from each group's own size (``pick_k``): of the
    group's points in the order of ``t`` (a day number) and ``tie``, the first
    k, or with ``runs`` the first k * runs dealt out to that many runs
    (column ``run``). A run of a group with too few points has fewer centres.

    The points are numbered by the chunked ``ordered_index``, a day to a chunk."""
    from .series import ordered_index

    group, many = list(group), runs or 1
    sizes = points.groupBy(*group).agg(pick_k(F.count(F.lit(1))).alias("_k"))
    ranked = ordered_index(points.withColumn("_t", t), group, "_t", "_i", chunk_seconds=1, tiebreak=[tie])
    chosen = ranked.join(sizes, group).where(F.col("_i") <= F.col("_k") * many)
    at = F.col("_i") - 1
    run = [(at % many).cast("int").alias("run")] if runs else []
    return chosen.select(*group, *run, F.floor(at / many).cast("int").alias("cluster_id"), *features)


def _name(group: Sequence[str]) -> Column:
    """The name of a row's group in the kernel."""
    return F.to_json(F.struct(*group), {"ignoreNullFields": "false"}) if group else F.lit("")


class Gathered:
    """Centres by group name and run, as matrices ordered by cluster id."""

    def __init__(self, names: Sequence[str], runs: Sequence[int], ids: Sequence[int], at: np.ndarray, weights: dict | None = None):
        order = sorted(range(len(ids)), key=lambda i: (names[i], runs[i], ids[i]))
        self.names, self.runs, self.ids = ([x[i] for i in order] for x in (names, runs, ids))
        self.at, self.order = np.asarray(at, np.float64)[order], order
        self.weights = weights  # by group: one factor a feature
        self.parts: dict[str, list[tuple[int, int, int]]] = {}
        start = 0
        for end in range(1, len(order) + 1):
            if end == len(order) or (self.names[end], self.runs[end]) != (self.names[start], self.runs[start]):
                self.parts.setdefault(self.names[start], []).append((self.runs[start], start, end))
                start = end

    def __getstate__(self) -> dict:
        """What tasks need: neither names nor runs of the single centres."""
        return {"ids": np.asarray(self.ids, np.int32), "at": self.at, "weights": self.weights, "parts": self.parts}

    def nearest(self, points: np.ndarray, name: str, measured: bool = True) -> Iterator[tuple[slice, np.ndarray, np.ndarray | None]]:
        """Per block of points: its place, and for each run of the group (a
        column each) the place in ``at`` of the nearest centre and, if
        ``measured``, the squared distance; ties to the lower id, -1 where no
        distance is a number."""
        parts = self.parts.get(name)
        if not parts:
            return
        first, last = parts[0][1], parts[-1][2]
        own = self.at[first:last]
        factor = self.weights[name] if self.weights else None
        cuts = [(s - first, e - first) for _, s, e in parts]
        most = max(e - s for s, e in cuts)
        step = max(1, _CELLS // max(len(own), most * len(cuts)))
        shape = None if factor is None else np.sqrt(factor)
        middle = own.mean(axis=0)
        shift = own - middle if shape is None else (own - middle) * shape
        small = bool((np.abs(shift) < _BOUND).all() and (np.abs(own) < _BOUND).all())  # false for what is not a number
        length = (shift * shift).sum(axis=1)
        product = np.zeros((own.shape[1] + 1, len(cuts), most))  # runs side by side, shorter ones filled up
        product[-1] = _BOUND * _BOUND * _BOUND
        for r, (s, e) in enumerate(cuts if small else ()):
            product[:-1, r, : e - s], product[-1, r, : e - s] = -2 * shift[s:e].T, length[s:e]
        for a in range(0, len(points), step):
            block = points[a: a + step]
            if small and (np.abs(block) < _BOUND).all():
                place, d2 = _by_product(block, own, factor, cuts, block - middle if shape is None else (block - middle) * shape, product, length.max(), measured)
            else:
                place, d2 = _by_feature(block, own, factor, cuts)
            place[place >= 0] += first
            yield slice(a, a + len(block)), place, d2


def _by_feature(block: np.ndarray, own: np.ndarray, factor: np.ndarray | None, cuts: Sequence[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``own`` of the nearest centre, squared distance), a column a run."""
    d2 = np.zeros((len(block), len(own)))
    for f in range(own.shape[1]):
        diff = block[:, f, None] - own[None, :, f]
        d2 += diff * diff if factor is None else diff * diff * factor[f]
    d2[np.isnan(d2)] = np.inf
    place = np.column_stack([d2[:, s:e].argmin(axis=1) + s for s, e in cuts])
    least = np.take_along_axis(d2, place, axis=1)
    place[np.isinf(least)] = -1
    return place, least


def _by_product(block: np.ndarray, own: np.ndarray, factor: np.ndarray | None, cuts: Sequence[tuple[int, int]], shifted: np.ndarray,
                product: np.ndarray, longest: float, measured: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """The same by one matrix product: |c|^2 - 2 p c, which lacks |p|^2 only.
    Points with a second centre within what rounding may add go ``_by_feature``."""
    near = (np.column_stack([shifted, np.ones(len(block))]) @ product.reshape(len(product), -1)).reshape(len(block), *product.shape[1:])
    slack = _SLACK * ((shifted * shifted).sum(axis=1) + longest)
    at = near.argmin(axis=2)
    limit = np.take_along_axis(near, at[:, :, None], axis=2) + slack[:, None, None]
    beside = near <= limit
    close = np.zeros(len(block), bool)
    if np.count_nonzero(beside) > at.size:
        close = (np.count_nonzero(beside, axis=2) > 1).any(axis=1)
    place = at + [s for s, _ in cuts]
    d2 = None
    if measured:
        d2 = np.zeros(place.shape)
        for f in range(own.shape[1]):
            diff = block[:, f, None] - own[place, f]
            d2 += diff * diff if factor is None else diff * diff * factor[f]
    for part in np.array_split(np.nonzero(close)[0], max(1, int(close.sum()) * len(own) // _CELLS + 1)):
        if len(part):
            place[part], least = _by_feature(block[part], own, factor, cuts)
            if measured:
                d2[part] = least
    return place, d2


def _gathered(centers: DataFrame, group: Sequence[str], features: Sequence[str]) -> Gathered | None:
    """The centres on the driver, or None where they are more than ``MOST_CENTERS``."""
    run = F.col("run") if "run" in centers.columns and "run" not in group else F.lit(0)
    rows = centers.select(_name(group).alias("name"), run.cast("int").alias("run"), F.col("cluster_id").cast("int").alias("id"),
                          *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)])
    got = rows.limit(MOST_CENTERS + 1).toArrow()
    if got.num_rows > MOST_CENTERS:
        return None
    at = np.column_stack([np.asarray(got.column(f"f{i}")) for i in range(len(features))])
    return Gathered(got.column("name").to_pylist(), got.column("run").to_pylist(), got.column("id").to_pylist(), at)


def _matrix(batch: pa.RecordBatch, features: Sequence[str]) -> np.ndarray:
    return np.column_stack([np.asarray(batch.column(f).cast(pa.float64()).fill_null(float("nan")), dtype=np.float64) for f in features])


def _by_group(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    """Group names of a batch and the places of their rows, in the batch's order."""
    coded = pc.dictionary_encode(batch.column("_group"))
    codes, names = np.asarray(coded.indices), coded.dictionary.to_pylist()
    order = np.argsort(codes, kind="stable")
    ends = np.cumsum(np.bincount(codes, minlength=len(names)))
    for name, start, end in zip(names, [0, *ends[:-1]], ends, strict=True):
        yield name, order[start:end]


def _grouped(points: DataFrame, group: Sequence[str]) -> Column:
    """The points' ``_group``, of ``laid_out`` or made here."""
    return (F.col("_group") if "_group" in points.columns else _name(group)).alias("_group")


def laid_out(points: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Points written by ranges of their group and ``order``, with the group's
    name in ``_group``: a task's points are of few groups, and a large group
    lies in several files, at least twice as many as there are cores."""
    named = points.select("*", _name(group).alias("_group"))
    return stage(named.repartitionByRange(spread_over(points.sparkSession), "_group", *order).sortWithinPartitions("_group", *order), name)


def _sums(points: DataFrame, held: Gathered, group: Sequence[str], features: Sequence[str], measured: bool) -> DataFrame:
    """(place, n, s0, s1, ..., cost): per centre the number, sums and (if
    ``measured``) squared distances of the points nearest to it; one partial row
    a task and centre."""
    shared = points.sparkSession.sparkContext.broadcast(held)
    names = [f"s{i}" for i in range(len(features))]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        total = np.zeros((len(own.ids), len(features) + 2))
        for batch in batches:
            at = _matrix(batch, features)
            for name, rows in _by_group(batch):
                mine = at[rows]
                for block, place, d2 in own.nearest(mine, name, measured):
                    whole = bool((place >= 0).all())
                    for r, (_, start, end) in enumerate(own.parts[name]):
                        some = slice(None) if whole else place[:, r] >= 0
                        to = place[some, r] - start
                        values = [None, *mine[block][some].T, *([d2[some, r]] if measured else [])]
                        for i, v in enumerate(values):
                            total[start:end, i] += np.bincount(to, weights=v, minlength=end - start)
        used = np.nonzero(total[:, 0])[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(total[used, i]) for i in range(total.shape[1])]], names=["place", "n", *names, "cost"])

    rows = points.select(_grouped(points, group), *features)
    partial = rows.mapInArrow(scan, "place long, n double, " + ", ".join(f"{x} double" for x in names) + ", cost double")
    return partial.groupBy("place").agg(*[F.sum(x).alias(x) for x in ("n", *names, "cost")])


def _stepped(points: DataFrame, held: Gathered, group: Sequence[str], features: Sequence[str],
             measured: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centres, numbers of points, costs if ``measured``) after one Lloyd step; a centre without points keeps its place."""
    got = _sums(points, held, group, features, measured).toArrow()  # one row a centre at most
    place, n = np.asarray(got.column("place")), np.zeros(len(held.ids))
    cost, at = np.zeros(len(held.ids)), held.at.copy()
    n[place], cost[place] = np.asarray(got.column("n")), np.asarray(got.column("cost"))
    for i in range(len(features)):
        at[place, i] = np.asarray(got.column(f"s{i}")) / n[place]
    return at, n, cost


def _table(centers: DataFrame, held: Gathered, group: Sequence[str], features: Sequence[str], at: np.ndarray, **more: np.ndarray) -> DataFrame:
    """The centres' table with new places, and further columns."""
    runs = ["run"] if "run" in centers.columns and "run" not in group else []
    table = pa.table({"_name": held.names, "_run": pa.array(held.runs, pa.int32()), "_id": pa.array(held.ids, pa.int32()),
                      **{f: at[:, i] for i, f in enumerate(features)}, **{k: pa.array(v) for k, v in more.items()}})
    rows = centers.sparkSession.createDataFrame(table)
    of = F.from_json("_name", centers.select(*group).schema) if group else None
    return rows.select(*[of[g].alias(g) for g in group], *[F.col("_run").alias(r) for r in runs], F.col("_id").alias("cluster_id"), *features, *more)


def spread(points: DataFrame, group: Sequence[str], features: Sequence[str] = FEATURES) -> dict[str, np.ndarray]:
    """M7: by group, one over the (population) variance of each feature: the
    weights under which distances are those of standardised features. A feature
    that does not vary has weight 0. Centres need no mapping back: means of
    standardised points are standardised means."""
    rows = points.groupBy(_name(group).alias("name")).agg(*[F.var_pop(f).alias(f"v{i}") for i, f in enumerate(features)])
    got = rows.limit(MOST_CENTERS + 1).toArrow()
    if got.num_rows > MOST_CENTERS:
        raise ValueError(f"more than {MOST_CENTERS} groups to standardise")
    v = np.column_stack([np.asarray(got.column(f"v{i}")) for i in range(len(features))])
    with np.errstate(divide="ignore"):
        return dict(zip(got.column("name").to_pylist(), np.where(v > 0, 1 / v, 0.0), strict=True))


def in_runs(points: DataFrame, runs: int) -> DataFrame:
    """Each point once per run (column ``run``): for the join beyond ``MOST_CENTERS``."""
    return points.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))))


def best_run(points: DataFrame, centers: DataFrame, group: Sequence[str], features: Sequence[str] = FEATURES) -> DataFrame:
    """M2: per group the centres of the run of least cost (to 6 places; ties:
    the first run), with ``run`` and ``cost``. ``centers`` has ``run``."""
    group = list(group)
    held = _gathered(centers, group, features)
    if held is None:
        runs = centers.agg(F.max("run")).first()[0] + 1
        cost = nearest_center(in_runs(points, runs), centers.select(*group, "run", "cluster_id", *features), [*group, "run"], features) \
            .groupBy(*group, "run").agg(F.sum("d2").alias("cost"))
    else:
        _, _, costs = _stepped(points, held, group, features, measured=True)
        cost = _table(centers, held, group, features, held.at, cost=costs).groupBy(*group, "run").agg(F.sum("cost").alias("cost"))
    cost = cost.withColumn("cost", F.round(F.col("cost") + 1e-9, 6))
    best = cost.groupBy(*group).agg(F.min(F.struct("cost", "run")).alias("_b")).select(*group, F.col("_b.run").alias("run"), F.col("_b.cost").alias("cost"))
    return centers.join(best, [*group, "run"])


def first_k_centers(points: DataFrame, group: Sequence[str], order: Sequence[str], k: int,
                    features: Sequence[str] = FEATURES) -> DataFrame:
    """Deterministic start centres: the first ``k`` points of each group.

    ``row_number() <= k`` with a literal k lets Spark cut each partition to its
    local top k before the shuffle (window group limit)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return (points.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
            .select(*group, (F.col("_r") - 1).cast("int").alias("cluster_id"), *features))


def centers_array(centers: DataFrame, group: Sequence[str], features: Sequence[str]) -> DataFrame:
    """One row per group with its centres as ``array<struct<cluster_id, f...>>``."""
    return centers.groupBy(*group).agg(
        F.sort_array(F.collect_list(F.struct("cluster_id", *features))).alias("_centers"))


def _d2(point: Sequence[Column], c: Column, features: Sequence[str]) -> Column:
    out = None
    for p, f in zip(point, features):
        term = (p - c[f]) * (p - c[f])
        out = term if out is None else out + term
    return out


def nearest_center(points: DataFrame, centers: DataFrame, group: Sequence[str],
                   features: Sequence[str] = FEATURES) -> DataFrame:
    """The closest centre (squared Euclidean distance) of each point's
    group; ties go to the lower ``cluster_id``. Adds ``cluster_id`` and ``d2``;
    points of a group without centres go."""
    group = list(group)
    held = _gathered(centers, group, features)
    if held is None:
        return _nearest_by_join(points, centers, group, features)
    shared = points.sparkSession.sparkContext.broadcast(held)
    names = points.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        known = np.asarray(own.ids, np.int32)
        for batch in batches:
            at = _matrix(batch, features)
            ids, least, kept = np.full(len(at), -1, np.int32), np.full(len(at), np.inf), np.zeros(len(at), bool)
            for name, rows in _by_group(batch):
                for block, place, d2 in own.nearest(at[rows], name):
                    to = rows[block]
                    ids[to], least[to], kept[to] = np.where(place < 0, -1, known[place])[:, 0], d2[:, 0], True
            cols = [batch.column(c) for c in names] + [pa.array(ids), pa.array(least)]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "cluster_id", "d2"]).filter(pa.array(kept))

    from pyspark.sql.types import DoubleType, IntegerType, StructType

    schema = StructType([*points.schema.fields]).add("cluster_id", IntegerType()).add("d2", DoubleType())
    return points.select(*names, *([] if "_group" in names else [_grouped(points, group)])).mapInArrow(scan, schema)


def _nearest_by_join(points: DataFrame, centers: DataFrame, group: Sequence[str], features: Sequence[str]) -> DataFrame:
    """The same with centres too many to gather: a join with the array of the
    group's centres, the group's points salted."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt")
    arr = centers_array(centers, group, features).select("*", salts)
    pts = [F.col(f) for f in features]
    init = F.struct(F.lit(float("inf")).alias("d2"), F.lit(-1).alias("cluster_id"))

    def step(acc, c):
        d = _d2(pts, c, features)
        return F.when(d < acc["d2"], F.struct(d.alias("d2"), c["cluster_id"].alias("cluster_id"))) \
            .otherwise(acc)

    best = F.aggregate(F.col("_centers"), init, step)
    salted = points.withColumn("_salt", F.pmod(F.xxhash64(*features), F.lit(_SALTS)).cast("int"))
    return (salted.join(arr, [*group, "_salt"])
            .withColumn("_best", best)
            .select(*points.columns, F.col("_best.cluster_id").alias("cluster_id"),
                    F.col("_best.d2").alias("d2")))


def cluster_cost(assigned: DataFrame, group: Sequence[str]) -> DataFrame:
    """Sum of distances (the helper of the original) and of squared
    distances (k-means cost) per group."""
    return assigned.groupBy(*group).agg(F.sum(F.sqrt("d2")).alias("sum_dist"),
                                        F.sum("d2").alias("cost"),
                                        F.count(F.lit(1)).alias("n_points"))


def lloyd_step(points: DataFrame, centers: DataFrame, group: Sequence[str],
               features: Sequence[str] = FEATURES) -> DataFrame:
    """M5: one Lloyd step; a centre without points keeps its place."""
    return lloyd(points, centers, group, 1, features)


def lloyd(points: DataFrame, centers: DataFrame, group: Sequence[str], iterations: int,
          features: Sequence[str] = FEATURES, weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """M6: ``iterations`` Lloyd steps for every group, and every run of the
    column ``run`` of ``centers``, at once; fewer where no centre moves any more.
    ``weights``: of the features by group (``spread``). Give written points, they
    are read once a step. Returns the centres with ``n_points``."""
    group = list(group)
    held = _gathered(centers, group, features)
    if held is None:
        if weights:
            raise ValueError("too many centres to standardise")
        return _lloyd_by_join(points, centers, group, iterations, features)
    held.weights = weights
    n = np.zeros(len(held.ids))
    for _ in range(iterations):
        at, n, _ = _stepped(points, held, group, features)
        still = (at == held.at).all()
        held.at = at
        if still:
            break
    return _table(centers, held, group, features, held.at, n_points=n.astype(np.int64))


def _lloyd_by_join(points: DataFrame, centers: DataFrame, group: Sequence[str], iterations: int, features: Sequence[str]) -> DataFrame:
    """The same with centres too many to gather: each step's centres are written
    to the cluster's shared folder."""
    keys = list(group)
    if "run" in centers.columns and "run" not in group:
        points, keys = in_runs(points, centers.agg(F.max("run")).first()[0] + 1), [*group, "run"]
    c = centers
    for _ in range(iterations):
        means = _nearest_by_join(points, c, keys, features).groupBy(*keys, "cluster_id").agg(
            *[F.avg(f).alias("_m_" + f) for f in features], F.count(F.lit(1)).alias("n_points"))
        c = stage(c.select(*keys, "cluster_id", *features).join(means, [*keys, "cluster_id"], "left")
                  .select(*keys, "cluster_id", *[F.coalesce(F.col("_m_" + f), F.col(f)).alias(f) for f in features],
                          F.coalesce(F.col("n_points"), F.lit(0)).alias("n_points")), "lloyd_centers")
    return c


def sampled_centers(points: DataFrame, k: int, tag: Column, features: Sequence[str] = FEATURES) -> DataFrame:
    """M3: a random start that any engine can repeat: the k points of least MD5
    of ``tag`` (a string, unique to a point). Each task keeps its k least; these are merged."""
    by = F.md5(tag.cast("binary"))
    few = points.select(by.alias("_by"), *features).orderBy("_by").limit(k)  # k rows, half the root of all
    return few.select((F.row_number().over(Window.orderBy("_by")) - 1).alias("cluster_id"), *features)


def kmeans_fit(spark: SparkSession, points: DataFrame, k: int, seeds: Sequence[int] = (0,),
               max_iter: int = 10, init_mode: str = "random",
               features: Sequence[str] = FEATURES) -> tuple[DataFrame, float, int]:
    """M1-M3: ``pyspark.ml`` k-means (raw features, random start, 10
    iterations); with several seeds the run of least cost is kept (the old
    ``runs=10``). Returns (centres as rows, cost, seed)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    from pyspark import StorageLevel

    vec = VectorAssembler(inputCols=list(features), outputCol="features",
                          handleInvalid="skip").transform(points).select("features")
    vec = vec.persist(StorageLevel.MEMORY_AND_DISK)

    def fit(seed):
        model = KMeans(k=k, maxIter=max_iter, initMode=init_mode, seed=seed,
                       featuresCol="features").fit(vec)
        return model, model.summary.trainingCost, seed

    try:
        # the runs are independent Spark jobs over one cached input: submit them
        # together so the cluster schedules their tasks side by side
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=min(len(seeds), 8)) as pool:
            runs = list(pool.map(fit, seeds))
    finally:
        vec.unpersist()
    model, cost, seed = min(runs, key=lambda r: (r[1], r[2]))
    rows = [(i, *[float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    schema = "cluster_id int, " + ", ".join(f"{f} double" for f in features)
    return spark.createDataFrame(rows, schema), float(cost), int(seed)
