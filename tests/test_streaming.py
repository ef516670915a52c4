"""Ingestion over many batches, after losses and failed fetches; files that grow; leases and runs with failing sources."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from groundplan.streaming import ingest, schedule, settle


def files(spark, folder, batches, schema="k int, v string"):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}")


def take(spark, tmp_path, parse=None, **more):
    schema = more.pop("schema", None) or spark.read.parquet(f"{tmp_path}/in").schema
    stream = ingest.file_stream(spark, f"{tmp_path}/in", "parquet", schema, files_per_trigger=more.pop("files", 1000))
    parse = parse or (lambda b: b.withColumn("parsed", F.col("v").isNotNull()))
    q = ingest.ingest(stream, "k", parse, *[f"{tmp_path}/{n}" for n in ("out", "dead", "checkpoint")], **more)
    q.awaitTermination()
    return q


def rows(spark, tmp_path, name="out"):
    return sorted(((r.k, r.v) for r in spark.read.parquet(f"{tmp_path}/{name}").collect()), key=lambda r: (r[0] is None, r[0] or 0, str(r[1])))


def test_bytes_read_stay_the_same_over_fifty_batches(spark, tmp_path):
    """What a batch reads from files doesn't grow with the keys that came before."""
    read = lambda: sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics() if s.getScheme() == "file")
    for i in range(50):
        spark.range(i * 400, i * 400 + 450).select(F.col("id").cast("int").alias("k"), F.lit("x" * 20).alias("v")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    each = []

    def parse(batch):
        each.append(read())
        return batch.withColumn("parsed", F.lit(True))

    before, parts = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        take(spark, tmp_path, parse, files=1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    steps = [b - a for a, b in zip(each, each[1:], strict=False)]
    assert len(each) == 50
    assert sorted(steps[-10:])[5] < 1.2 * sorted(steps[4:14])[5]  # but for the batches in which Spark compacts its logs
    got = rows(spark, tmp_path)
    assert len(got) == len(set(got)) == 49 * 400 + 450


def test_a_batch_repeated_after_a_loss_adds_nothing(spark, tmp_path):
    files(spark, f"{tmp_path}/in", [[(1, "a"), (1, "b"), (2, None), (None, "n"), (None, "m")]])
    take(spark, tmp_path)
    files(spark, f"{tmp_path}/in", [[(1, "again"), (3, "c"), (2, "again"), (None, "again")]])
    calls = []

    def lost(batch):
        calls.append(1)
        if len(calls) == 1:  # the first table has been written, then the job is lost
            batch.withColumn("parsed", F.lit(True)).write.parquet(f"{tmp_path}/never")
            raise RuntimeError("lost")
        return batch.withColumn("parsed", F.col("v").isNotNull())

    with pytest.raises(Exception, match="lost"):
        take(spark, tmp_path, lost)
    take(spark, tmp_path, lost)
    got = rows(spark, tmp_path, "out")
    assert [k for k, _ in got if k] == [1, 3] and sum(k is None for k, _ in got) == 1 and rows(spark, tmp_path, "dead") == [(2, None)]
    # the last batch once more: its commit is lost, its rows are not
    commits = f"{tmp_path}/checkpoint/commits"
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if os.path.exists(f"{commits}/{f}"):
            os.remove(f"{commits}/{f}")
    take(spark, tmp_path)
    assert rows(spark, tmp_path, "out") == got


def test_fetch_errors_come_again_and_parse_errors_do_not(spark, tmp_path):
    files(spark, f"{tmp_path}/in", [[(i, "x") for i in range(1, 31)]])
    k, turn = F.col("k"), F.col("_try")
    parse = lambda b: b.withColumn("parsed", F.when(k % 7 == 0, F.lit(None)).when((k % 5 == 0) & (turn == 0), F.lit(None)).otherwise(k % 3 != 0))
    for _ in range(5):
        take(spark, tmp_path, parse, retry=f"{tmp_path}/retry", tries=3)
    assert [k for k, _ in rows(spark, tmp_path)] == [i for i in range(1, 31) if i % 7 and i % 3]
    assert [k for k, _ in rows(spark, tmp_path, "dead")] == [i for i in range(1, 31) if i % 7 == 0 or i % 3 == 0]


def test_keys_of_an_archive_are_skipped_and_keys_are_forgotten(spark, tmp_path):
    spark.createDataFrame([(1,), (None,)], "k int").write.parquet(f"{tmp_path}/old")
    files(spark, f"{tmp_path}/in", [[(1, "a"), (2, "b"), (None, "c")]])
    take(spark, tmp_path, seen=f"{tmp_path}/old")
    assert rows(spark, tmp_path) == [(2, "b")]
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    for batch in ([(1, "a", at(0))], [(1, "b", at(1))], [(9, "z", at(90))], [(8, "y", at(91))], [(1, "c", at(92))]):
        spark.createDataFrame(batch, "k int, v string, t timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/timed/in")
        take(spark, f"{tmp_path}/timed", files=1, within=("t", "2 hours"))
    assert rows(spark, f"{tmp_path}/timed") == [(1, "a"), (1, "c"), (8, "y"), (9, "z")]


def seen(spark, tmp_path, got, patience=60.0):
    take = lambda batch, number: got.extend((os.path.basename(r.path), r.length, r.settled) for r in batch.collect())
    settle.watch(settle.settled(spark, f"{tmp_path}/looks", patience), take, f"{tmp_path}/settling").awaitTermination()


def test_a_growing_file_comes_once_and_whole(spark, tmp_path):
    folder = tmp_path / "shots"
    folder.mkdir()
    got = []
    for number in range(6):
        if number < 3:
            with open(folder / "grows.png", "ab") as f:
                f.write(b"x" * 100)
            os.utime(folder / "grows.png", (1_700_000_000 + number, 1_700_000_000 + number))
        if number == 0:
            (folder / "later.PNG").write_bytes(b"1")
            os.utime(folder / "later.PNG", (1_700_000_500, 1_700_000_500))
            (folder / "sooner.jpg").write_bytes(b"22")
            os.utime(folder / "sooner.jpg", (1_700_000_100, 1_700_000_100))
            (folder / "empty.png").write_bytes(b"")
            (folder / "note.txt").write_text("no image")
        settle.look(spark, str(folder), f"{tmp_path}/looks", number)
        seen(spark, tmp_path, got)
    assert got == [("sooner.jpg", 2, True), ("later.PNG", 1, True), ("grows.png", 300, True)]


def test_patience_ends_and_no_backlog(spark, tmp_path):
    folder = tmp_path / "shots"
    folder.mkdir()
    (folder / "old.png").write_bytes(b"old")
    os.utime(folder / "old.png", (1_600_000_000, 1_600_000_000))
    got = []
    for number in range(3):
        with open(folder / "endless.png", "ab") as f:
            f.write(b"x")
        settle.look(spark, str(folder), f"{tmp_path}/looks", number, since=1_650_000_000)
        seen(spark, tmp_path, got, patience=0.2)
        time.sleep(0.4)
    assert len(got) == 1 and got[0][0] == "endless.png" and got[0][2] is False


def source(tmp_path, name, fail=False):
    def start(spark):
        stream = ingest.file_stream(spark, f"{tmp_path}/in", "parquet", spark.read.parquet(f"{tmp_path}/in").schema)

        def parse(batch):
            if fail:
                raise RuntimeError(f"{name} is down")
            return batch.withColumn("parsed", F.lit(True))

        return ingest.ingest(stream, "k", parse, *[f"{tmp_path}/{name}/{n}" for n in ("out", "dead", "checkpoint")], name=None)

    return start


def broken(spark):
    raise ValueError("no such site")


def test_a_failing_source_stops_no_other(spark, tmp_path):
    files(spark, f"{tmp_path}/in", [[(i, "x") for i in range(20)]])
    built = []
    lease = schedule.Lease(spark, f"{tmp_path}/lock")
    sources = {"a": source(tmp_path, "a"), "b": source(tmp_path, "b", fail=True), "c": broken, "d": source(tmp_path, "d")}
    out = schedule.run_once(spark, sources, lease, after=lambda: built.append(1))
    assert out.errors["a"] is None and out.errors["d"] is None and "b is down" in out.errors["b"] and "no such site" in out.errors["c"]
    assert (out.rows["a"], out.rows["d"], out.rows["c"]) == (20, 20, 0) and not out.ok and built == [1]
    assert lease.read() is None


def test_two_schedulers_one_run_and_takeover(spark, tmp_path):
    now = [1000.0]
    leases = [schedule.Lease(spark, f"{tmp_path}/lock", 60, lambda: now[0]) for _ in range(3)]
    with leases[0]:
        leases[0].check()
        with pytest.raises(schedule.Busy), leases[1]:
            pass
        now[0] += 50
        assert leases[0].renew()
        now[0] += 50
        with pytest.raises(schedule.Busy), leases[1]:
            pass
        now[0] += 61  # the first has stopped renewing: the second takes over, and the first notices
        with leases[1]:
            with pytest.raises(schedule.Busy):
                leases[0].check()
            assert not leases[0].renew()
            with pytest.raises(schedule.Busy), leases[2]:
                pass
        assert leases[0].read() is None
    with open(f"{tmp_path}/lock/lease", "w") as f:
        f.write("not json")
    if os.path.exists(f"{tmp_path}/lock/.lease.crc"):
        os.remove(f"{tmp_path}/lock/.lease.crc")
    with leases[2]:
        leases[2].check()


def test_schedule_goes_on(spark, tmp_path):
    told, slept, clock = [], [], [dt.datetime(2026, 1, 1, 10, 0)]
    turns = iter([lambda: schedule.Outcome({"a": 3}, {"a": None}), lambda: (_ for _ in ()).throw(schedule.Busy("held")), lambda: 1 / 0])

    def sleep(seconds):
        slept.append(seconds)
        clock[0] += dt.timedelta(seconds=seconds)

    schedule.run_forever(lambda: next(turns)(), lambda: clock[0], sleep, told.append, at="02:30", turns=3)
    assert told[0] == "a: 3 rows" and told[1].startswith("skipped: held") and told[2].startswith("failed: division")
    assert slept == [16.5 * 3600, 24 * 3600]
