from __future__ import annotations

import datetime as dt
import hashlib
import pathlib

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas, session
from ledgerloom.functions.encoding import BROKEN
from ledgerloom.session import new_folder
from ledgerloom.sources import landing, lines, sinks
from ledgerloom.streaming import batchlog, delivery, observer_stream


def write(folder, name, content):
    path = pathlib.Path(folder)
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_bytes(content if isinstance(content, bytes) else content.encode())


def test_csv_row_of_the_wrong_shape_keeps_its_text(spark, tmp_path):
    write(tmp_path, "part1.csv", "id,name\n1, a \nx,b\n")
    write(tmp_path, "part2.csv", "id,name\n2,\n")
    got = landing.read_csv(spark, str(tmp_path), schemas.struct(id="long", name="str")).cache()
    assert got.filter("_corrupt IS NULL").count() == 2
    assert got.filter("_corrupt IS NOT NULL").first()["_corrupt"] == "x,b"
    assert got.filter("id = 1").first()["name"] == " a "


def test_json_lines_keep_broken_rows(spark, tmp_path):
    write(tmp_path, "a.jsonl", '{"id": 1}\n{"id": \n')
    got = landing.read_json_lines(spark, str(tmp_path), schemas.struct(id="long")).cache()
    assert [r["id"] for r in got.filter("_corrupt IS NULL").collect()] == [1]
    assert got.filter("_corrupt IS NOT NULL").count() == 1


def test_nested_orders_without_lines_keep_a_row(spark, tmp_path):
    write(tmp_path, "page.json", '[{"user_id": 1, "lines": [{"k": 3}, {"k": 4}]}, {"user_id": 2}]')
    orders = landing.read_json_arrays(spark, str(tmp_path), schemas.WEB_ORDER)
    assert orders.count() == 2
    rows = landing.explode_lines(orders).orderBy("user_id", "line_pos").collect()
    assert [(r["user_id"], r["line_pos"], r["k"]) for r in rows] == [
        (1, 0, 3), (1, 1, 4), (2, None, None)]


def test_only_the_published_bytes_are_accepted(spark, tmp_path):
    good, other = b"PAR1\x00\xff", b"changed"
    for name, content in {"a.bin": good, "b.bin": other, "c.bin": b"new"}.items():
        write(tmp_path / "in", name, content)
    published = spark.createDataFrame(
        [(n, hashlib.sha256(good).hexdigest()) for n in ("a", "b", "d")], "name string, sha256 string")
    digests = landing.file_digests(spark, str(tmp_path / "in"), r"([a-z]+)\.bin")
    got = {r["name"]: r["verdict"] for r in landing.verify_delivery(digests, published).collect()}
    assert got == {"a": "accepted", "b": "quarantined", "c": "not_published", "d": "not_delivered"}


def test_line_stream_keeps_data_lines_only(spark):
    rows = [(v,) for v in (
        'data: {"run": 1, "kind": "job"}', '   data:{"run": 2}  ', ": ping", "event: data:",
        "data: {oops", "", "data: ", None)]
    frame = spark.createDataFrame(rows, "value string")
    parsed = lines.parse_events(frame)
    assert sorted(r["run"] for r in lines.good_events(parsed).filter("run > 0").collect()) == [1, 2]
    assert "{oops" in [r["value"] for r in lines.broken_lines(parsed).collect()]


def test_observer_replays_nothing_twice(spark):
    landed, log = new_folder(spark, "t-lines"), new_folder(spark, "t-log")
    check = new_folder(spark, "t-lines-check")
    rows = [('data: {"run": 1, "seq": %d, "kind": "job", "status": "Failed"}' % i,) for i in range(9)]
    rows += [("data: {bad",), (": ping",)]
    frame = spark.createDataFrame(rows, "value string")
    frame.repartition(3).write.text(landed)
    first = observer_stream.observe(spark, landed, log, check, files_per_batch=1)
    assert first.count() == 10
    frame.limit(1).write.mode("append").text(landed)
    again = observer_stream.observe(spark, landed, log, check, files_per_batch=1)
    totals = observer_stream.totals(again).first()
    assert (totals["lines_read"], totals["events"], totals["broken_lines"]) == (11, 10, 1)
    assert again.filter(F.col(BROKEN).isNull() & (F.col("tag") == "JOB")).count() == 10
    counted = [r["events_so_far"] for r in observer_stream.progress(again).orderBy("batch").collect()]
    assert counted == sorted(counted) and counted[-1] == 11


def test_a_batch_written_twice_is_there_once(spark):
    folder = new_folder(spark, "t-batch")
    for _ in range(2):
        batchlog.write_batch(spark.range(4), 7, folder)
    got = batchlog.read_log(spark, folder, spark.range(1).schema)
    assert [(r["batch"], r["rows_in"]) for r in batchlog.batch_sizes(got).collect()] == [(7, 4)]


def test_one_refresh_per_delivery(spark):
    data, notes, runs, check = (new_folder(spark, n) for n in ("t-d", "t-m", "t-r", "t-rc"))
    landed = spark.range(40).select(
        (F.col("id") % 2).cast("string").alias("delivery_id"), (F.col("id") % 5).alias("part"))
    sinks.write_table(landed, data, partition_by="delivery_id")
    landing_table = lambda: spark.read.schema("part bigint, delivery_id string").parquet(data)

    def announce(*ids):
        for one in ids:
            spark.createDataFrame([(one,)], "value string").coalesce(1).write.mode("append").text(notes)

    def refresh():
        return sorted((r["delivery_id"], r["parts"], r["n_rows"]) for r in
                      delivery.refresh_on_marker(
                          delivery.markers(spark, notes, 1), landing_table, runs, check).collect())

    announce("1", "1")
    assert refresh() == [("1", 5, 20)]
    announce("0", "1", "none")
    assert refresh() == [("0", 5, 20), ("1", 5, 20)]


def test_late_first_rows_are_counted(spark):
    landed, out, check = (new_folder(spark, n) for n in ("t-late", "t-late-out", "t-late-check"))
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    for batch in ([(1, 0), (2, 50)], [(1, 0), (3, 50)], [(4, 1)]):
        rows = [(i, start + dt.timedelta(hours=h)) for i, h in batch]
        spark.createDataFrame(rows, "id int, ts timestamp").coalesce(1).write.mode("append").parquet(landed)
    stream = spark.readStream.schema("id int, ts timestamp").option("maxFilesPerTrigger", 1).parquet(landed)
    late = delivery.run_redelivery_stream(
        delivery.drop_redeliveries(stream, ["id"], "ts", "1 hour"), out, check)
    assert late > 0


def test_late_rows_of_every_batch_are_counted(spark):
    """More batches than a query keeps progress of; the late rows come early on."""
    landed, out, check = (new_folder(spark, n) for n in ("t-many", "t-many-out", "t-many-check"))
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(0, start + dt.timedelta(days=9))] + [(i, start) for i in range(1, 6)]
    rows += [(i, start + dt.timedelta(days=9, minutes=i)) for i in range(6, 110)]
    for row in rows[:6]:
        spark.createDataFrame([row], "id int, ts timestamp").coalesce(1).write.mode("append").parquet(landed)
    spark.createDataFrame(rows[6:], "id int, ts timestamp").coalesce(1).write.mode("append").option(
        "maxRecordsPerFile", 1).parquet(landed)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        stream = spark.readStream.schema("id int, ts timestamp").option("maxFilesPerTrigger", 1).parquet(landed)
        late = delivery.run_redelivery_stream(
            delivery.drop_redeliveries(stream, ["id"], "ts", "1 hour"), out, check)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    kept = spark.read.parquet(out).count()
    assert late >= 4 and kept + late == len(rows)


def test_without_a_delay_no_copy_is_too_far_apart(spark):
    landed, out, check = (new_folder(spark, n) for n in ("t-far", "t-far-out", "t-far-check"))
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    for day in (400, 0, 900, 400):
        row = [(1, start + dt.timedelta(days=day))]
        spark.createDataFrame(row, "id int, ts timestamp").coalesce(1).write.mode("append").parquet(landed)
    stream = spark.readStream.schema("id int, ts timestamp").option("maxFilesPerTrigger", 1).parquet(landed)
    assert delivery.run_redelivery_stream(delivery.drop_redeliveries(stream, ["id"]), out, check) == 0
    assert spark.read.parquet(out).count() == 1


def test_gate_stays_shut_on_a_short_stream(spark):
    report = spark.createDataFrame([(0, True), (1, False)], "p int, complete boolean")
    folder = new_folder(spark, "t-gate")
    assert not delivery.publish_if_complete(report, spark.range(2), folder)
    assert not pathlib.Path(folder).exists()
    assert delivery.publish_if_complete(report.filter("complete"), spark.range(2), folder)


def test_partitioned_table_and_document_round_trip(spark):
    frame = spark.range(10).withColumn("y", (F.col("id") % 3).cast("string"))
    folder = sinks.write_table(frame, new_folder(spark, "t-part"), partition_by="y")
    back = landing.read_master(spark, folder, frame.schema)
    assert back.filter("y = '1'").count() == 3
    doc = sinks.write_document({"a": frame, "b": frame.limit(1)}, new_folder(spark, "t-doc"))
    assert spark.read.schema(frame.schema).json(f"{doc}/a").count() == 10


class Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.value or default


class Context:
    applicationId = "app-1"

    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    def __init__(self, master, folder):
        self.sparkContext, self.conf = Context(master), Conf(folder)


def test_shared_folder_comes_from_the_session():
    fake = FakeSession("spark://x", "hdfs://shared/cp/")
    assert session.shared_root(fake) == "hdfs://shared/cp"
    assert session.new_folder(fake, "t").startswith("hdfs://shared/cp/app-1/t-")


@pytest.mark.parametrize("told", ["/tmp", "/proc/self/cwd/.tmp", "/mnt/scratch"])
def test_a_temporary_folder_of_one_machine_is_refused_on_a_cluster(monkeypatch, told):
    monkeypatch.setattr(session.tempfile, "tempdir", told)
    for folder in ("file:///tmp/x", "file:/tmp/x", "/tmp", "file:///var/tmp/y", f"{told}/z"):
        with pytest.raises(ValueError):
            session.shared_root(FakeSession("spark://x", folder))
        assert session.shared_root(FakeSession("local[2]", folder)) == folder.rstrip("/")
    for folder in ("file:/mnt/shared", "hdfs://tmp/x", "hdfs:///tmp/x", "/tmpfiles/x"):
        assert session.shared_root(FakeSession("spark://x", folder)) == folder


def test_exchanges_start_as_wide_as_the_input(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        session.tune(spark, 10 << 40)
        assert spark.conf.get(key) == str((10 << 40) // session.PARTITION_BYTES)
    finally:
        spark.conf.unset(key)


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError):
        session.shared_root(FakeSession("spark://x", None))
