"""Alignment (J1-J3, J6, G1, G2) against a plain-Python restatement of the
collector's cursor loop, on random series with gaps, ties and early ends."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rackpulse.operators import align

BASE = 1704067200  # 2024-01-01 00:00:00 UTC


def _day(epoch):
    return dt.date(1970, 1, 1) + dt.timedelta(days=epoch // 86400)


def loop_restatement(fw, fr, cpu, disk, net, h):
    """The collector's row loop over sorted dicts {epoch: value}; where the
    original would raise (a cursor running off the end), the row is kept with
    complete=False."""
    fwk, frk, ck, dk, nk = (sorted(x) for x in (fw, fr, cpu, disk, net))
    keylimit = min(len(fwk), len(frk), len(ck), len(dk), len(nk))

    def findavg(t, it, keys, d):
        dps = []
        while it < len(keys) and keys[it] < t + h:
            dps.append(d[keys[it]])
            it += 1
        ok = it < len(keys)
        if dps:
            return sum(dps) / float(len(dps)), it, ok
        return (d[keys[it]] if ok else None), it, ok

    def findcpu(t, it, keys, d):
        while it < len(keys) and keys[it] < t:
            it += 1
        ok = it < len(keys)
        return (d[keys[it]] if ok else None), it, ok

    rows, di, ci, ni = [], 0, 0, 0
    for i in range(keylimit):
        t = fwk[i]
        dv, di, dok = findavg(t, di, dk, disk)
        cv, ci, cok = findcpu(t, ci, ck, cpu)
        nv, ni, nok = findavg(t, ni, nk, net)
        rows.append((i + 1, t, fw[t], fr[frk[i]], cv, dv, nv, dok and cok and nok))
    return rows


def _series(rnd, day, n, cadence, early_end=False, gap=False):
    start = BASE + day * 86400
    out, t = {}, start + rnd.randint(0, cadence)
    limit = start + (15000 if early_end else 86000)
    while len(out) < n and t < limit:
        out[t] = round(rnd.uniform(0, 100), 2)
        t += rnd.randint(1, cadence) + (3000 if gap and rnd.random() < 0.05 else 0)
    return out


def _build(rnd, days=2, servers=3):
    data, rows = {}, []
    for d in range(days):
        fw = _series(rnd, d, 120, 600)
        fr = _series(rnd, d, 118, 600)
        for m, s in (("filewrites", fw), ("filereads", fr)):
            rows += [(None, m, _day(e), e, v) for e, v in s.items()]
        for srv in range(servers):
            cpu = _series(rnd, d, 300, 250, early_end=(srv == 1))
            disk = _series(rnd, d, 200, 400, gap=True)
            net = _series(rnd, d, 150, 700, early_end=(srv == 2))
            for m, s in (("CPU", cpu), ("diskIOBW", disk), ("net_bytes", net)):
                rows += [(srv, m, _day(e), e, v) for e, v in s.items()]
            data[(srv, _day(BASE + d * 86400))] = (fw, fr, cpu, disk, net)
    return data, rows


@pytest.mark.parametrize("seed,chunk", [(1, 3600), (2, 500), (3, 97)])
def test_aligned_matches_loop(spark, seed, chunk):
    rnd = random.Random(seed)
    data, rows = _build(rnd)
    samples = spark.createDataFrame(rows, "server int, metric string, day date, epoch long, value double")
    h = 30 if seed != 2 else 600
    got = {(r.server, r.day, r.rn): r for r in
           align.aligned_metrics(samples, half_window=h, chunk_seconds=chunk).collect()}
    expected = 0
    for (srv, day), series in data.items():
        for (rn, t, fw, fr, cv, dv, nv, ok) in loop_restatement(*series, h):
            expected += 1
            r = got[(srv, day, rn)]
            assert r.time == t and r.filewrites == fw and r.filereads == fr
            assert r.CPU == cv
            assert (r.diskIOBW is None and dv is None) or abs(r.diskIOBW - dv) < 1e-9
            assert (r.net_bytes is None and nv is None) or abs(r.net_bytes - nv) < 1e-9
            assert r.complete == ok
    assert expected == len(got)
    # the early-ending series produce incomplete rows
    assert any(not r.complete for r in got.values())


def test_bucket_edges(spark):
    """Samples exactly at t, t+29 and t+30: the cut t+30 belongs to the next row."""
    t0, t1 = BASE + 1000, BASE + 1200
    day = _day(BASE)
    grid = spark.createDataFrame([(0, day, 1, t0), (0, day, 2, t1)], "server int, day date, rn int, time long")
    s = spark.createDataFrame([(0, day, t0, 1.0), (0, day, t0 + 29, 3.0), (0, day, t0 + 30, 10.0),
                               (0, day, t1 + 100, 7.0)], "server int, day date, epoch long, value double")
    r = {x.rn: x for x in align.bucket_mean(grid, s, ["server", "day"], 30).collect()}
    assert r[1].value == 2.0 and r[1].value_n == 2 and r[1].value_ok
    assert r[2].value == 10.0 and r[2].value_n == 1 and r[2].value_ok


def test_empty_bucket_takes_next_sample(spark):
    day = _day(BASE)
    grid = spark.createDataFrame([(0, day, 1, BASE), (0, day, 2, BASE + 60)], "server int, day date, rn int, time long")
    s = spark.createDataFrame([(0, day, BASE + 500, 4.0)], "server int, day date, epoch long, value double")
    r = {x.rn: x for x in align.bucket_mean(grid, s, ["server", "day"], 30).collect()}
    assert r[1].value == 4.0 and r[1].value_n == 0
    assert r[2].value == 4.0 and r[2].value_n == 0  # after the last cut: in no bucket


def test_positional_join_pairs_by_rank_not_time(spark):
    day = _day(BASE)
    w = spark.createDataFrame([(day, BASE + 10, 1.0), (day, BASE + 70, 2.0), (day, BASE + 130, 3.0)],
                              "day date, epoch long, value double")
    r = spark.createDataFrame([(day, BASE + 65, 9.0), (day, BASE + 200, 8.0)], "day date, epoch long, value double")
    got = sorted((x.rn, x.time, x.filewrites, x.filereads) for x in align.positional_join(w, r).collect())
    assert got == [(1, BASE + 10, 1.0, 9.0), (2, BASE + 70, 2.0, 8.0)]


def test_shortest_truncate_and_empty_groups(spark):
    day = _day(BASE)
    rows = [(None, "filewrites", day, BASE + i, 1.0) for i in range(5)]
    rows += [(None, "filereads", day, BASE + i, 1.0) for i in range(4)]
    rows += [(0, "CPU", day, BASE + i, 1.0) for i in range(3)]
    rows += [(0, "diskIOBW", day, BASE + i, 1.0) for i in range(6)]
    rows += [(0, "net_bytes", day, BASE + i, 1.0) for i in range(6)]
    rows += [(1, "CPU", day, BASE + i, 1.0) for i in range(3)]   # server 1 lacks disk and net
    s = spark.createDataFrame(rows, "server int, metric string, day date, epoch long, value double")
    lim = {r.server: r.keylimit for r in align.shortest_truncate(s).collect()}
    assert lim == {0: 3, 1: 0}
    empty = [(r.server, r.n_diskIOBW) for r in align.empty_groups(s).collect()]
    assert empty == [(1, 0)]
    assert align.aligned_metrics(s).count() == 3


def test_plan_has_no_python_and_no_single_partition_window(spark):
    from rackpulse.plans import QUERIES
    plan = QUERIES["aligned_metrics"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    assert "SinglePartition" not in plan
