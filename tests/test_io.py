"""Sources (S1, S6-S8, S13, S15, S16) and sinks (K1, K3, K4, K7), by writing
fixtures to a scratch folder and reading them back."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rackpulse.sources import metrics as M
from rackpulse.sources import sinks as K
from rackpulse.streaming.ingest import ingest_available, read_ingested


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_metric_response_first_and_sum(spark, tmp_dir):
    resp = [{"metric": "zpool.iobw", "tags": {"host": "node3.example"}, "dps": {"999": 1.0, "1000": 2.0}},
            {"metric": "zpool.iobw", "tags": {"host": "node3.example", "op": "read"}, "dps": {"1000": 5.0}}]
    _write(f"{tmp_dir}/r/a.json", json.dumps(resp))
    _write(f"{tmp_dir}/r/b.json", json.dumps([{"metric": "file.writes", "tags": {"host": "site"}, "dps": {}}]))
    first = sorted((r.server, r.epoch, r.value) for r in M.read_metric_responses(spark, f"{tmp_dir}/r").collect())
    assert first == [(3, 999, 1.0), (3, 1000, 2.0)]           # numeric order of keys of different length
    summed = sorted((r.epoch, r.value) for r in M.read_metric_responses(spark, f"{tmp_dir}/r", "sum").collect())
    assert summed == [(999, 1.0), (1000, 7.0)]


def test_build_and_parse_round_trip(spark):
    s = spark.createDataFrame([(None, "filewrites", 86400 * 19000 + 5, 1.5), (2, "CPU", 86400 * 19000 + 7, 3.0)],
                              "server int, metric string, epoch long, value double") \
        .withColumn("day", M.day_of_epoch(F.col("epoch")))
    back = M.parse_metric_response(M.build_metric_responses(s), "value")
    assert sorted(((r.server, r.metric, r.epoch, r.value) for r in back.collect()), key=lambda x: x[1]) == \
        [(2, "CPU", 86400 * 19000 + 7, 3.0), (None, "filewrites", 86400 * 19000 + 5, 1.5)]


def test_aligned_csv_keeps_bad_rows_apart(spark, tmp_dir):
    _write(f"{tmp_dir}/c/2014-07-09-10-00", "100,1,2,3.5,4,5\n\n101,1,2,x,4,5\n")
    df = M.read_aligned_csv(spark, f"{tmp_dir}/c").cache()
    good = df.where(F.col("_corrupt").isNull()).collect()
    assert [(r.time, r.CPU) for r in good] == [(100, 3.5)]
    assert df.where(F.col("_corrupt").isNotNull()).count() == 1     # the bad number; the blank line is skipped


def test_text_logs_flat_recursive_glob(spark, tmp_dir):
    _write(f"{tmp_dir}/l/a.log", "x Shelf\n")
    _write(f"{tmp_dir}/l/sub/b.log", "y Shelf\n")
    _write(f"{tmp_dir}/l/sub/c.txt", "z Shelf\n")
    os.makedirs(f"{tmp_dir}/l/empty", exist_ok=True)
    assert M.read_text_logs(spark, f"{tmp_dir}/l/*.log").count() == 1
    assert M.read_text_logs(spark, f"{tmp_dir}/l", recursive=True).count() == 3
    assert M.read_text_logs(spark, f"{tmp_dir}/l", recursive=True, glob="*.log").count() == 2


def test_points_csv_coercion(spark, tmp_dir):
    _write(f"{tmp_dir}/p/points.csv", "filewrites,filereads,CPU,diskIOBW,net bytes\n1,2,3.5,4, 5\n,abc,1,1,1\n")
    rows = M.read_points_csv(spark, f"{tmp_dir}/p").collect()
    assert rows[0].net_bytes == 5.0 and rows[1].filewrites is None and rows[1].filereads is None


def test_sinks_round_trip(spark, tmp_dir):
    import datetime as dt
    d = dt.date(2014, 7, 9)
    al = spark.createDataFrame([(0, d, 100, 1.0, 2.0, 3.0, 4.0, 5.0), (1, d, 160, 1.0, 2.0, 3.0, 4.0, 5.0)],
                               "server int, day date, time long, filewrites double, filereads double, CPU double,"
                               " diskIOBW double, net_bytes double")
    K.write_aligned(al, f"{tmp_dir}/al")
    assert sorted(d for d in os.listdir(f"{tmp_dir}/al") if d.startswith("server=")) == ["server=0", "server=1"]
    back = spark.read.parquet(f"{tmp_dir}/al").where("server = 1")
    assert back.count() == 1 and "PartitionFilters: [isnotnull(server" in back._jdf.queryExecution() \
        .executedPlan().toString()
    K.write_aligned(al, f"{tmp_dir}/alc", fmt="csv")
    assert spark.read.csv(f"{tmp_dir}/alc").count() == 2
    K.write_points_csv(al, f"{tmp_dir}/pts")
    hdr = spark.read.option("header", True).csv(f"{tmp_dir}/pts").columns
    assert hdr == ["filewrites", "filereads", "CPU", "diskIOBW", "net bytes"]
    c = al.withColumn("cluster_id", F.col("server"))
    K.write_centers_csv(c, f"{tmp_dir}/ctr")
    assert len([f for f in os.listdir(f"{tmp_dir}/ctr") if f.endswith(".csv")]) == 1
    q = spark.createDataFrame([('say "hi"', "a,b")], "x string, y string")
    K.write_delimited(q, f"{tmp_dir}/dsv")
    text = "".join(open(os.path.join(f"{tmp_dir}/dsv", f)).read() for f in os.listdir(f"{tmp_dir}/dsv")
                   if f.endswith(".csv"))
    assert '"say ""hi"""' in text and '"a,b"' in text


def test_incremental_ingest_takes_each_file_once(spark, tmp_dir):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])
    src, dst, ck = f"{tmp_dir}/src", f"{tmp_dir}/dst", f"{tmp_dir}/ck"
    spark.createDataFrame([(1, 1.0), (2, 2.0)], schema).write.mode("append").parquet(src)
    ingest_available(spark, src, dst, ck, schema)
    ingest_available(spark, src, dst, ck, schema)          # nothing new: nothing copied again
    spark.createDataFrame([(3, 3.0)], schema).write.mode("append").parquet(src)
    ingest_available(spark, src, dst, ck, schema)
    assert sorted(r.id for r in read_ingested(spark, dst).collect()) == [1, 2, 3]


def test_ingest_walks_folders_and_goes_by_age(spark, tmp_dir):
    import datetime as dt
    schema = T.StructType([T.StructField("id", T.LongType())])
    now = dt.datetime(2024, 5, 1, 12, tzinfo=dt.timezone.utc)
    for i, (where, hours) in enumerate([("a.csv", 1), ("sub/b.csv", 1), ("sub/deep/c.csv", 3), ("d.csv", 48)]):
        _write(f"{tmp_dir}/src/{where}", f"{i}\n")
        age = now.timestamp() - hours * 3600
        os.utime(f"{tmp_dir}/src/{where}", (age, age))
    ingest_available(spark, f"{tmp_dir}/src", f"{tmp_dir}/dst", f"{tmp_dir}/ck", schema, "csv", 7200, now, clean_names=True)
    assert sorted((r.id, r.source_file) for r in read_ingested(spark, f"{tmp_dir}/dst").collect()) == [(0, "a.csv"), (1, "b.csv")]
    ingest_available(spark, f"{tmp_dir}/src", f"{tmp_dir}/all", f"{tmp_dir}/ck2", schema, "csv")
    assert sorted(r.id for r in read_ingested(spark, f"{tmp_dir}/all").collect()) == [0, 1, 2, 3]


def test_named_results_are_seen_whole(spark, tmp_dir):
    import glob
    import os

    import pytest

    from rackpulse.sources import sinks as K

    feats = "name string, filewrites double, filereads double, CPU double, diskIOBW double, net_bytes double"
    points = spark.createDataFrame([(n, float(i), 1.0, 2.0, 3.0, 0.1) for n in ("2014-01-01_01-02_sense1", "b c") for i in range(50)], feats)
    centers = points.where("filewrites < 3")
    path = tmp_dir + "/results"
    K.write_named(points, centers, path)
    assert K.read_named(spark, path).groupBy("name", "kind").count().count() == 4
    assert K.read_named(spark, path).count() == 106
    K.write_named(points.where("name = 'b c' AND filewrites < 9"), centers.where("name = 'b c'"), path)  # one name is replaced
    got = {(r.name, r.kind): r["count"] for r in K.read_named(spark, path).groupBy("name", "kind").count().collect()}
    assert got[("b c", "point")] == 9 and got[("2014-01-01_01-02_sense1", "point")] == 50
    for f in glob.glob(f"{path}/points/name=b*/part-*"):
        os.remove(f)
    with pytest.raises(ValueError):
        K.read_named(spark, path)


def test_files_are_copied_as_files(spark, tmp_dir):
    import datetime as dt
    import gzip

    from rackpulse.streaming.copies import copy_files, read_ledger
    now = dt.datetime(2024, 5, 1, 12, tzinfo=dt.timezone.utc)
    src, dst, ledger = f"{tmp_dir}/from", f"{tmp_dir}/to", f"{tmp_dir}/ledger"

    def put(where, data, hours=1.0):
        os.makedirs(os.path.dirname(f"{src}/{where}"), exist_ok=True)
        with open(f"{src}/{where}", "wb") as f:
            f.write(data)
        os.utime(f"{src}/{where}", (now.timestamp() - hours * 3600,) * 2)

    def tree():
        return {os.path.relpath(os.path.join(d, f), dst): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(dst) for f in fs}

    long = bytes(range(256)) * 70_000  # two pieces and more
    put("2024-05-01 10:30.log", b"a\n")
    put("sub/deep/b:c.bin", long)
    put("sub/x.gz", gzip.compress(b"stays packed"))
    put("empty", b"")
    put("old", b"old", hours=3)
    put("same:name", b"first")
    put("same-name", b"held")
    os.makedirs(f"{src}/nothing")
    first = copy_files(spark, src, dst, ledger, 7200, now).collect()
    want = {"2024-05-01 10-30.log": b"a\n", "sub/deep/b-c.bin": long, "sub/x.gz": gzip.compress(b"stays packed"), "empty": b"", "same-name": b"held"}
    assert tree().keys() == want.keys() and tree()["sub/deep/b-c.bin"] == long and tree()["same-name"] == b"held"
    assert gzip.decompress(tree()["sub/x.gz"]) == b"stays packed" and tree()["2024-05-01 10-30.log"] == b"a\n"
    assert sorted((r.status, os.path.basename(r.source)) for r in first if r.status != "copied") == [("clash", "same:name")]
    assert copy_files(spark, src, dst, ledger, 7200, now).count() == 0
    put("empty", b"now more", hours=0.5)
    put("late", b"late", hours=0.5)
    assert sorted(os.path.basename(r.target) for r in copy_files(spark, src, dst, ledger, 7200, now).collect()) == ["empty", "late"]
    assert tree()["empty"] == b"now more" and tree().keys() == want.keys() | {"late"}
    assert read_ledger(spark, ledger).count() == 8
    os.makedirs(f"{tmp_dir}/bare")
    assert copy_files(spark, f"{tmp_dir}/bare", dst, f"{tmp_dir}/ledger2").count() == 0


def test_staged_tables_follow_their_input(spark, tmp_dir):
    from rackpulse.session import stage_once
    src = f"{tmp_dir}/input"

    def total():
        return stage_once(spark, "probe", src, lambda: spark.read.parquet(f"{src}/t.parquet")).count()

    spark.range(5).write.parquet(f"{src}/t.parquet")
    assert total() == 5 == total()
    spark.range(7).write.mode("overwrite").parquet(f"{src}/t.parquet")
    assert total() == 7


def test_month_offsets_run_over(spark):
    from rackpulse.functions import timefns as TF
    df = spark.sql("select timestamp_ntz'2024-01-31 10:20:30.5' as t union all select timestamp_ntz'2023-01-31 00:00:00' union all select timestamp_ntz'2024-02-29 01:00:00'")
    ts = F.col("t")
    got = {r[0]: tuple(r)[1:] for r in df.select(TF.text(ts), TF.text(TF.offset(ts, "month", 1)), TF.text(TF.offset(ts, "month", -2)), TF.text(TF.offset(ts, "year", 1)),
                                               TF.iso_format(ts), TF.epoch_micros(ts) % 1_000_000).collect()}
    assert got["2024-01-31 10:20:30"] == ("2024-03-02 10:20:30", "2023-12-01 10:20:30", "2025-01-31 10:20:30", "2024-01-31T10:20:30.500Z", 500_000)
    assert got["2023-01-31 00:00:00"][0] == "2023-03-03 00:00:00"
    assert got["2024-02-29 01:00:00"] == ("2024-03-29 01:00:00", "2023-12-29 01:00:00", "2025-03-01 01:00:00", "2024-02-29T01:00:00.000Z", 0)
