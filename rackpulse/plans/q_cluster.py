"""Queries over clustering (P1, G6, G7, J7, M1-M7) and its named results (K3-K5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cluster as C
from .. import tables as T
from ..operators import selection as S
from ..session import scratch_path, spread_over, stage_once
from ..sources import sinks as K
from .q_align import ALIGNED_SQL, q_aligned_metrics
from .q_select import ASOF, REQ
from .registry import ORACLES, query

GROUP = ["server"]
ITERATIONS = 10  # Lloyd steps of a clustering
RUNS = 10        # starts, of which the best is kept
FEATS = C.FEATURES

NOT_NULL = " AND ".join(f"{f} IS NOT NULL AND NOT isnan({f})" for f in FEATS)
FLIST = ", ".join(FEATS)
K_SQL = "greatest(2, floor(sqrt(count(*)) / 2))"


def starts_sql(pts: str, keys: str, name: str, runs: int = 1) -> str:
    """Start centres: the first k points (k from the group's size), dealt out to runs."""
    run = f"CAST((r - 1) % {runs} AS INTEGER) AS run, " if runs > 1 else ""
    using = keys.replace(" ", "")
    return f"""
{name} AS (SELECT {keys}, {run}CAST((r - 1) // {runs} AS INTEGER) AS cluster_id, {FLIST}
         FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY day, rn) AS r FROM {pts}) t
         JOIN (SELECT {keys}, {K_SQL} AS k FROM {pts} GROUP BY {keys}) n USING ({using})
         WHERE r <= k * {runs})"""


POINTS_CTE = f"""
pts AS (SELECT server, day, rn, {FLIST} FROM ({ALIGNED_SQL}) a WHERE {NOT_NULL}),{starts_sql("pts", "server", "ctr0")}
"""
D2 = " + ".join(f"(p.{f} - c.{f}) * (p.{f} - c.{f})" for f in FEATS)


def assign_sql(ctr: str, name: str, pts: str = "pts", keys: str = "server") -> str:
    ks = ", ".join(f"p.{k.strip()}" for k in keys.split(","))
    using = keys.replace(" ", "")
    return f"""
{name}_d AS (SELECT {ks}, p.day, p.rn, c.cluster_id, {D2} AS d2 FROM {pts} p JOIN {ctr} c USING ({using})),
{name} AS (SELECT {keys}, day, rn, cluster_id, d2 FROM
           (SELECT *, row_number() OVER (PARTITION BY {keys}, day, rn ORDER BY d2, cluster_id) AS kk
            FROM {name}_d) t WHERE kk = 1)"""


def step_sql(ctr: str, asg: str, name: str, pts: str = "pts", keys: str = "server") -> str:
    means = ", ".join(f"avg(p.{f}) AS {f}" for f in FEATS)
    keep = ", ".join(f"coalesce(m.{f}, c.{f}) AS {f}" for f in FEATS)
    ks = ", ".join(f"c.{k.strip()}" for k in keys.split(","))
    using = keys.replace(" ", "")
    return f"""
{name}_m AS (SELECT {keys}, cluster_id, {means}, count(*) AS n_points FROM {asg} a
             JOIN {pts} p USING ({using}, day, rn) GROUP BY {keys}, cluster_id),
{name} AS MATERIALIZED (SELECT {ks}, c.cluster_id, {keep}, coalesce(m.n_points, 0) AS n_points
           FROM {ctr} c LEFT JOIN {name}_m m USING ({using}, cluster_id))"""


def lloyd_sql(iters: int, ctr: str = "ctr0", pts: str = "pts", keys: str = "server") -> str:
    """``iters`` steps; the last centres are ``c<iters>``."""
    parts = []
    for i in range(1, iters + 1):
        parts += [assign_sql(ctr, f"a{i}", pts, keys), step_sql(ctr, f"a{i}", f"c{i}", pts, keys)]
        ctr = f"c{i}"
    return ",".join(parts)


def best_sql(keys: str, pts: str) -> str:
    """Costs of the last centres of every run and the best run (``best``)."""
    return f"""{assign_sql(f"c{ITERATIONS}", "fin", pts, keys + ", run")},
costs AS (SELECT {keys}, run, round(sum(d2) + 1e-9, 6) AS cost FROM fin GROUP BY {keys}, run),
best AS (SELECT {keys}, run, cost FROM
         (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY cost, run) AS b FROM costs) t WHERE b = 1)"""


def _points(spark, sf_dir, staged: bool = True):
    """The aligned rows with all five features, written once per input (the K1
    table): every clustering and view query reads the written table with its
    own pruning instead of building it again."""
    return stage_once(spark, "points", sf_dir, lambda: C.feature_rows(q_aligned_metrics(spark, sf_dir)).select("server", "day", "rn", *FEATS))


def _centers(points):
    return C.start_centers(points, GROUP, F.unix_date("day"), "rn")


def _fitted(spark, sf_dir):
    """The centres of each server's clustering, written once per input."""
    def fit():
        p = _points(spark, sf_dir)
        return C.lloyd(p, _centers(p), GROUP, ITERATIONS)

    return stage_once(spark, "fitted", sf_dir, fit)


def r6cols(df, cols):
    """Round to 6 places; means get a 1e-9 nudge so that an exact tie (a mean
    ending in 5 at the 7th place) rounds the same way in every engine."""
    return df.select(*[F.round(F.col(c) + 1e-9, 6).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


@query("feature_rows", f"""
WITH {POINTS_CTE}
SELECT server, day, rn, {", ".join(FEATS)} FROM pts
""")
def q_feature_rows(spark, sf_dir):
    return _points(spark, sf_dir, staged=False)


@query("pick_k", f"""
WITH {POINTS_CTE}
SELECT server, count(*) AS n_points,
       CAST(greatest(2, floor(sqrt(count(*)) / 2)) AS INTEGER) AS k
FROM pts GROUP BY server
""")
def q_pick_k(spark, sf_dir):
    p = _points(spark, sf_dir, staged=False).groupBy("server").agg(F.count(F.lit(1)).alias("n_points"))
    return p.withColumn("k", C.pick_k(F.col("n_points")))


@query("nearest_center", f"""
WITH {POINTS_CTE}, {assign_sql("ctr0", "a1")}
SELECT server, day, rn, cluster_id, round(d2, 6) AS d2 FROM a1
""")
def q_nearest_center(spark, sf_dir):
    p = _points(spark, sf_dir)
    a = C.nearest_center(p, _centers(p), GROUP)
    return a.select("server", "day", "rn", "cluster_id", F.round("d2", 6).alias("d2"))


@query("cluster_cost", f"""
WITH {POINTS_CTE}, {assign_sql("ctr0", "a1")}
SELECT server, round(sum(sqrt(d2)) + 1e-9, 6) AS sum_dist, round(sum(d2) + 1e-9, 6) AS cost,
       count(*) AS n_points
FROM a1 GROUP BY server
""")
def q_cluster_cost(spark, sf_dir):
    p = _points(spark, sf_dir)
    c = C.cluster_cost(C.nearest_center(p, _centers(p), GROUP), GROUP)
    return r6cols(c, ["sum_dist", "cost"])


@query("lloyd_step", f"""
WITH {POINTS_CTE}, {assign_sql("ctr0", "a1")}, {step_sql("ctr0", "a1", "c1")}
SELECT server, cluster_id, {", ".join(f"round({f} + 1e-9, 6) AS {f}" for f in FEATS)}, n_points FROM c1
""")
def q_lloyd_step(spark, sf_dir):
    p = _points(spark, sf_dir)
    return r6cols(C.lloyd_step(p, _centers(p), GROUP), FEATS)


ROUNDED = ", ".join(f"round({f} + 1e-9, 6) AS {f}" for f in FEATS)


@query("kmeans_per_server", f"""
WITH {POINTS_CTE}, {lloyd_sql(ITERATIONS)}
SELECT server, cluster_id, {ROUNDED}, n_points FROM c{ITERATIONS}
""")
def q_kmeans_per_server(spark, sf_dir):
    """M6: every server's clustering at once, k from its own number of points."""
    return r6cols(_fitted(spark, sf_dir), FEATS)


RUNS_CTE = f"rpts AS (SELECT *, run FROM pts, (SELECT CAST(unnest(range({RUNS})) AS INTEGER) AS run) u)"


@query("kmeans_best_of", f"""
WITH {POINTS_CTE}, {RUNS_CTE}, {starts_sql("pts", "server", "rctr", RUNS)},
{lloyd_sql(ITERATIONS, "rctr", "rpts", "server, run")}, {best_sql("server", "rpts")}
SELECT server, run, cluster_id, {ROUNDED}, n_points, cost FROM c{ITERATIONS} JOIN best USING (server, run)
""")
def q_kmeans_best_of(spark, sf_dir):
    """M2: ten starts per server in one Lloyd loop; the run of least cost wins."""
    p = C.laid_out(_points(spark, sf_dir), GROUP, ["day", "rn"], "server_points")
    c = C.lloyd(p, C.start_centers(p, GROUP, F.unix_date("day"), "rn", RUNS), GROUP, ITERATIONS)
    return r6cols(C.best_run(p, c, GROUP), FEATS).select("server", "run", "cluster_id", *FEATS, "n_points", "cost")


JOB = ["server", "start_day", "end_day"]
JOB_KEYS = ", ".join(JOB)


@query("kmeans_per_request", f"""
WITH {REQ}, {POINTS_CTE},
job AS (SELECT DISTINCT CAST(substring(server, 6) AS INTEGER) AS server, CAST(start_date AS DATE) AS start_day,
               CASE WHEN mode = 'range' THEN CAST(end_date AS DATE) ELSE CAST(start_date AS DATE) END AS end_day
        FROM modes WHERE mode IN ('single', 'range')),
jpts AS (SELECT p.*, j.start_day, j.end_day FROM job j JOIN pts p ON p.server = j.server AND p.day BETWEEN j.start_day AND j.end_day),
rpts AS (SELECT *, run FROM jpts, (SELECT CAST(unnest(range({RUNS})) AS INTEGER) AS run) u),
{starts_sql("jpts", JOB_KEYS, "rctr", RUNS)},
{lloyd_sql(ITERATIONS, "rctr", "rpts", JOB_KEYS + ", run")}, {best_sql(JOB_KEYS, "rpts")},
used AS (SELECT {JOB_KEYS}, strftime(min(day), '%Y-%m-%d') || '_' || strftime(max(day), '%m-%d') || '_sense' || server AS name
         FROM jpts GROUP BY {JOB_KEYS})
SELECT {JOB_KEYS}, name, run, cluster_id, {ROUNDED}, n_points, cost
FROM c{ITERATIONS} JOIN best USING ({JOB_KEYS.replace(" ", "")}, run) JOIN used USING ({JOB_KEYS.replace(" ", "")})
""")
def q_kmeans_per_request(spark, sf_dir):
    """The whole job: accepted requests -> the points of their days -> k from
    their number -> ten starts of ten steps -> the best run's centres under the
    result's name. All requests are clustered in one loop."""
    _, best = _request_results(spark, sf_dir)
    return r6cols(best, FEATS).select(*JOB, "name", "run", "cluster_id", *FEATS, "n_points", "cost")


def _request_results(spark, sf_dir):
    """(points, best centres) of every accepted request, under the result's name."""
    modes = S.request_mode(T.requests(spark, sf_dir), F.lit(ASOF).cast("date"))
    modes = modes.withColumn("server", F.regexp_extract("server", r"^sense(\d+)$", 1).cast("int"))
    s = F.to_date("start_date", "yyyy-MM-dd")
    jobs = S.request_days(modes.withColumn("start_day", s).withColumn(
        "end_day", F.when(F.col("mode") == "range", F.to_date("end_date", "yyyy-MM-dd")).otherwise(s)))
    # few rows by now, each of which stands for a day's points
    jobs = jobs.select(*JOB, "day").distinct().repartition(spread_over(spark), "server", "day")
    points = C.laid_out(jobs.join(_points(spark, sf_dir), ["server", "day"]), JOB, ["day", "rn"], "request_points")
    c = C.lloyd(points, C.start_centers(points, JOB, F.unix_date("day"), "rn", RUNS), JOB, ITERATIONS)
    names = S.output_name(points.select(F.struct(*JOB).alias("job"), "server", "day"), ["job"]).select("job.*", "name")
    return points.join(names, JOB), C.best_run(points, c, JOB).join(names, JOB)


_KPR = ORACLES["kmeans_per_request"]


@query("request_outputs", _KPR[:_KPR.rindex("SELECT " + JOB_KEYS)].rstrip() + f"""
, one AS (SELECT name, min((start_day, end_day)) AS job FROM used GROUP BY name),
mine AS (SELECT u.* FROM used u JOIN one o ON o.name = u.name AND o.job = (u.start_day, u.end_day))
SELECT name, 'center' AS kind, {ROUNDED} FROM c{ITERATIONS} JOIN best USING ({JOB_KEYS.replace(" ", "")}, run) JOIN mine USING ({JOB_KEYS.replace(" ", "")})
UNION ALL
SELECT name, 'point', {ROUNDED} FROM jpts JOIN mine USING ({JOB_KEYS.replace(" ", "")})
""")
def q_request_outputs(spark, sf_dir):
    """K3-K5: every request's points and centres written under the result's name
    in one job each, and read back through the manifest. Requests that use the same
    days of a server have one name and one result."""
    points, best = _request_results(spark, sf_dir)
    path = scratch_path(spark, "request_outputs")
    least = best.groupBy("name").agg(F.min(F.struct(*JOB)).alias("job")).select("name", "job.*")
    K.write_named(points.join(least, ["name", *JOB]), best.join(least, ["name", *JOB]), path)
    return r6cols(K.read_named(spark, path), FEATS).select("name", "kind", *FEATS)


@query("kmeans_centers", f"""
WITH {POINTS_CTE}, kk AS (SELECT {K_SQL} AS k FROM pts),
gpts AS (SELECT 0 AS g, server * 100000000 + rn AS rn, CAST(day AS VARCHAR) AS day, {FLIST} FROM pts),
gctr AS (SELECT 0 AS g, CAST(r - 1 AS INTEGER) AS cluster_id, {FLIST} FROM
         (SELECT *, row_number() OVER (ORDER BY md5(server || '|' || day || '|' || rn)) AS r FROM pts) t, kk WHERE r <= k),
{lloyd_sql(ITERATIONS, "gctr", "gpts", "g")}
SELECT cluster_id, {ROUNDED}, n_points FROM c{ITERATIONS}
""")
def q_kmeans_centers(spark, sf_dir):
    """M1/M3: one clustering of all aligned rows, k from G6, from a random start
    that is the same in every engine."""
    p = _points(spark, sf_dir)
    k = C.pick_k_value(p.agg(F.count("*")).first()[0])
    start = C.sampled_centers(p, k, F.concat_ws("|", "server", "day", "rn"))
    return r6cols(C.lloyd(p, start, [], ITERATIONS), FEATS)


STD_D2 = " + ".join(f"(p.{f} - c.{f}) * (p.{f} - c.{f}) * v_{f}" for f in FEATS)


def std_sql(iters: int) -> str:
    """Lloyd steps under the weights of ``sprd``."""
    return lloyd_sql(iters).replace(D2, STD_D2).replace("c USING (server))", "c USING (server) JOIN sprd USING (server))")


@query("kmeans_standardised", f"""
WITH {POINTS_CTE},
sprd AS (SELECT server, {", ".join(f"CASE WHEN var_pop({f}) > 0 THEN 1 / var_pop({f}) ELSE 0 END AS v_{f}" for f in FEATS)} FROM pts GROUP BY server),
{std_sql(ITERATIONS)}
SELECT server, cluster_id, {ROUNDED}, n_points FROM c{ITERATIONS}
""")
def q_kmeans_standardised(spark, sf_dir):
    """M7: every server's clustering with standardised features."""
    p = _points(spark, sf_dir)
    return r6cols(C.lloyd(p, _centers(p), GROUP, ITERATIONS, weights=C.spread(p, GROUP)), FEATS)
