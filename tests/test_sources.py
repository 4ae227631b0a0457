import os
import subprocess
import sys
from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.functions.timing import date_and_time
from tidemark.plans.validated_copy import publish_csv
from tidemark.plans.wordlist import frequent_words
from tidemark.scratch import scratch_root
from tidemark.session import LOCAL_SETTINGS, pin_session
from tidemark.sources.catalog import catalog_tables, register, scan_table, unregister
from tidemark.sources.files import infer_schema, merged_schema, value_schema, scan_csv, scan_json, scan_lines
from tidemark.sources.integrity import (ValidationError, file_digests, file_manifest, publish_validated,
                                        read_published, table_report, validate_dataset)
from tidemark.sources.records import (LATEST, backlog_options, decode_values, partition_ends, read_backlog, stream_options,
                                      stream_records, to_records, write_records)
from tidemark.streaming.output import BatchTable, append_result, drain, for_each_batch

READINGS = "day DATE, clock STRING, home STRING, used DOUBLE, outside DOUBLE, region STRING"
HEADER = "day,clock,home,used,outside,region"
ROWS = ["2024-02-01,00:30,H9,0.75,4.5,North", "2024-02-01,13:00,H9,1.25,9.0,North",
        "2024-02-02,23:59,H4,0.10,-2.0,South"]


def put(folder, name, lines, newline="\n", mark=False):
    path = os.path.join(folder, name)
    with open(path, "wb") as out:
        out.write((b"\xef\xbb\xbf" if mark else b"") + (newline.join(lines) + newline).encode())
    return path


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("mark", [False, True])
def test_csv_with_mark_and_line_ends(spark, folder, newline, mark):
    put(folder, "readings.csv", [HEADER, *ROWS], newline, mark)
    got = scan_csv(spark, folder, READINGS).orderBy("day", "clock").collect()
    assert tuple(got[0]) == (date(2024, 2, 1), "00:30", "H9", 0.75, 4.5, "North")
    assert tuple(got[2]) == (date(2024, 2, 2), "23:59", "H4", 0.10, -2.0, "South")
    stamped = scan_csv(spark, folder, READINGS).select(date_and_time("day", "clock").alias("at"))
    assert (datetime(2024, 2, 1, 13, 0),) in rows(stamped)
    report = validate_dataset(spark, folder, READINGS).first()
    assert (report["rows"], report["corrupt_rows"], report["has_header"], report["healthy"]) == (3, 0, True, True)


def test_bad_csv_rows_are_kept_apart_and_reported(spark, folder):
    put(folder, "readings.csv", [HEADER, *ROWS, "2024-02-03,01:00,H1,much,1.0,East", "2024-02-03,01:00,H1"])
    got = scan_csv(spark, folder, READINGS, keep_corrupt=True).cache()
    assert got.where("_corrupt_record IS NOT NULL").count() == 2
    report = validate_dataset(spark, folder, READINGS).first()
    assert (report["rows"], report["corrupt_rows"], report["healthy"]) == (5, 2, False)


def test_missing_header_and_empty_data_are_unhealthy(spark, folder):
    put(folder, "readings.csv", ROWS)
    report = validate_dataset(spark, folder, READINGS).first()
    assert not report["has_header"] and not report["healthy"]
    empty = os.path.join(folder, "empty")
    os.makedirs(empty)
    open(os.path.join(empty, "none.csv"), "w").close()
    report = validate_dataset(spark, empty, READINGS).first()
    assert report["rows"] == 0 and not report["healthy"]


def test_manifest_and_digests(spark, folder):
    put(folder, "one.csv", [HEADER, *ROWS])
    put(folder, "same.csv", [HEADER, *ROWS])
    put(folder, "turned.csv", [HEADER, *ROWS[::-1]], "\r\n", True)
    manifest = {r["file_name"]: r for r in file_manifest(spark, folder, READINGS).collect()}
    assert {r["rows"] for r in manifest.values()} == {3}
    assert len({r["checksum"] for r in manifest.values()}) == 1
    assert manifest["one.csv"]["file_size"] == os.path.getsize(os.path.join(folder, "one.csv"))
    put(folder, "paired.csv", [HEADER, *ROWS, ROWS[0], ROWS[0]])
    put(folder, "other.csv", [HEADER, *ROWS, ROWS[1], ROWS[1]])
    digests = {os.path.basename(r["path"]): (r["rows"], r["checksum"]) for r in file_digests(spark, folder).collect()}
    assert len(digests) == 5
    assert digests["one.csv"] == digests["same.csv"]
    assert digests["paired.csv"] != digests["other.csv"]


def test_a_refused_publish_leaves_the_good_copy(spark, folder):
    good = spark.range(5).toDF("id")
    publish_validated(good, table_report(good), folder)
    with pytest.raises(ValidationError, match="copy differs"):
        publish_validated(spark.range(3).toDF("id"), table_report(good), folder)
    assert sorted(r["id"] for r in read_published(spark, folder).collect()) == [0, 1, 2, 3, 4]
    newer = spark.range(7).toDF("id")
    publish_validated(newer, table_report(newer), folder)
    assert read_published(spark, folder).count() == 7


def test_publishing_is_gated_and_verified(spark, folder):
    source, target = os.path.join(folder, "in"), os.path.join(folder, "out")
    os.makedirs(source)
    put(source, "readings.csv", [HEADER, *ROWS], mark=True)
    copy = publish_csv(spark, source, READINGS, target)
    assert copy.count() == 3
    assert spark.read.parquet(f"{target}/report").first()["healthy"]

    put(source, "more.csv", [HEADER, "never,01:00,H1,1.0,1.0,East"])
    refused = os.path.join(folder, "refused")
    with pytest.raises(ValidationError):
        publish_csv(spark, source, READINGS, refused)
    assert os.path.exists(f"{refused}/report") and not os.path.exists(f"{refused}/data")
    wrong = table_report(copy).withColumn("checksum", F.lit(1).cast("bigint"))
    with pytest.raises(ValidationError, match="copy differs"):
        publish_validated(copy, wrong, os.path.join(folder, "other"))


def test_json_declared_keeps_bad_lines(spark, folder):
    put(folder, "p.json", ['{"id": 1, "user": {"name": "a"}}', '{"id": 2}', "{bad"])
    got = scan_json(spark, folder, "id BIGINT, user STRUCT<name: STRING>").cache()
    assert rows(got.select("id", "user.name", "_corrupt_record")) == [
        (1, "a", None), (2, None, None), (None, None, "{bad")]
    assert set(scan_json(spark, folder).columns) == {"id", "user", "_corrupt_record"}


def test_lines_and_frequent_words(spark, folder):
    put(folder, "p.json", ['{"tweet": "Una idea, una rosa"}', "broken", '{"tweet": "una rosa más"}'])
    assert scan_lines(spark, folder).count() == 3
    got = frequent_words(spark, folder, "tweet", k=2)
    assert [tuple(r) for r in got.collect()] == [("una", 3), ("rosa", 2)]


def test_schema_inference_from_a_sample(spark):
    texts = [f'{{"id": {i}, "reblog": null, "account": {{"name": "u{i}"}}}}' for i in range(10)]
    texts += ['{"id": 99, "reblog": {"id": 1}, "extra": true}']
    df = spark.createDataFrame(list(enumerate(texts)), "n INT, value STRING")
    seen = infer_schema(df, "value", 10, order_by="n")
    # An object that is null throughout is taken for text, a field outside the sample is unseen.
    assert seen["reblog"].dataType == T.StringType() and "extra" not in seen.fieldNames()
    assert seen["account"].dataType.fieldNames() == ["name"] and seen["id"].dataType == T.LongType()
    merged = infer_schema(df, "value", 10, order_by="n", declared="reblog STRUCT<id: BIGINT>, extra BOOLEAN")
    parsed = df.select(F.from_json("value", merged).alias("p"))
    assert parsed.where("p.reblog.id = 1 AND p.extra").count() == 1


def test_records_round_trip(spark, folder):
    numbers = spark.range(1, 251)
    records = to_records(numbers, "id", "id")
    assert records.dtypes == [("key", "binary"), ("value", "binary")]
    path = os.path.join(folder, "records")
    write_records(records, "files", path, topic="numbers")
    write_records(records.limit(0), "files", path)
    backlog = read_backlog(spark, "files", path)
    assert backlog.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]
    assert rows(decode_values(backlog, "bigint", "bigint")) == sorted(((i, i) for i in range(1, 251)), key=repr)
    assert backlog.groupBy("key").agg(F.countDistinct("partition").alias("n")).where("n > 1").count() == 0
    arrived = append_result(decode_values(stream_records(spark, "files", path), "bigint", "bigint"))
    assert arrived.count() == 250
    odd = to_records(spark.createDataFrame([("a", "x")], "k STRING, v STRING"), "k", "v")
    assert rows(decode_values(odd, "bigint", "bigint")) == [(None, None)]


def test_broker_options():
    assert stream_options("kafka", servers="h:1", topic="t", per_trigger=5) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "5"}
    assert backlog_options("kafka", servers="h:1", topic="t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest",
        "endingOffsets": "latest"}
    assert stream_options("files", per_trigger=2) == {"maxFilesPerTrigger": "2"}
    with pytest.raises(ValueError):
        stream_options("socket")
    with pytest.raises(ValueError):
        stream_options("kafka", topic="t")


def test_catalog(spark):
    register(spark.range(3), "three_rows")
    assert scan_table(spark, "three_rows").count() == 3
    register(spark.range(4), "three_rows")
    assert scan_table(spark, "three_rows").count() == 4
    assert rows(catalog_tables(spark).where("name = 'three_rows'")) == [("three_rows", None, True)]
    unregister(spark, "three_rows")
    unregister(spark, "three_rows")
    assert catalog_tables(spark).where("name = 'three_rows'").count() == 0


IN_NAMED_FOLDER = """
from tidemark import build_session
from tidemark.scratch import stage
spark = build_session("named", "local[1]", {{"spark.checkpoint.dir": "{0}/"}})
print(stage(spark.range(5)).inputFiles()[0])
"""


def test_working_folder_is_the_one_the_session_names(folder):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", IN_NAMED_FOLDER.format(folder)], cwd=root,
                          capture_output=True, text=True, timeout=120)
    assert done.stdout.strip().startswith(f"file://{folder}/tidemark/stage-"), done.stderr[-2000:]


def test_a_cluster_has_to_name_a_shared_folder():
    unnamed = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default),
                              sparkContext=SimpleNamespace(master="yarn", applicationId="a"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(unnamed)


def test_empty_files_and_misplaced_headers_are_seen(spark, folder):
    put(folder, "good.csv", [HEADER, *ROWS])
    assert validate_dataset(spark, folder, READINGS).first()["healthy"]
    put(folder, "odd name+%41é.csv", [HEADER, *ROWS, HEADER])
    os.makedirs(os.path.join(folder, "deep"))
    put(os.path.join(folder, "deep"), "turned.csv", [ROWS[0], HEADER, *ROWS[1:]])
    open(os.path.join(folder, "none.csv"), "w").close()
    put(folder, "blank.csv", ["", "", HEADER, *ROWS])
    manifest = {r["file_name"]: (r["rows"], r["corrupt_rows"], r["has_header"]) for r in file_manifest(spark, folder, READINGS).collect()}
    assert manifest == {"good.csv": (3, 0, True), "odd name+%41é.csv": (4, 1, True), "turned.csv": (4, 1, False),
                        "none.csv": (0, 0, False), "blank.csv": (3, 0, True)}
    sums = {r["file_name"]: r["checksum"] for r in file_manifest(spark, folder, READINGS).collect()}
    assert sums["good.csv"] == sums["blank.csv"] and sums["none.csv"] == 0
    report = validate_dataset(spark, folder, READINGS).first()
    assert (report["files"], report["healthy"], report["has_header"]) == (5, False, False)
    digests = {os.path.basename(r["path"]): (r["length"], r["rows"]) for r in file_digests(spark, folder).collect()}
    assert digests["none.csv"] == (0, 0) and digests["odd name+%41é.csv"][1] == 5 and len(digests) == 5


def test_one_empty_file_beside_a_good_one_is_unhealthy(spark, folder):
    put(folder, "good.csv", [HEADER, *ROWS])
    open(os.path.join(folder, "none.csv"), "w").close()
    report = validate_dataset(spark, folder, READINGS).first()
    assert (report["files"], report["rows"], report["healthy"]) == (2, 3, False)


def test_a_large_file_in_many_splits_has_its_header_judged_once(spark, folder):
    put(folder, "large.csv", [HEADER, *(ROWS * 3000)])
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        row, = file_manifest(spark, folder, READINGS).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    assert (row["rows"], row["corrupt_rows"], row["has_header"]) == (9000, 0, True)


def _numbers(spark, low, high, partition="id % 3"):
    return to_records(spark.range(low, high), "id", "id", partition=F.expr(partition))


def _held(records):
    return sorted((r["partition"], r["offset"], int(r["key"])) for r in records.collect())


def test_offsets_go_on_over_writes_and_topics(spark, folder):
    path = os.path.join(folder, "records")
    assert partition_ends(spark, path).count() == 0
    by_number = F.col("key").cast("string").cast("long")
    write_records(_numbers(spark, 0, 100).repartition(5), "files", path, topic="a", order_by=by_number)
    write_records(_numbers(spark, 0, 10), "files", path, topic="b", order_by=by_number)
    write_records(_numbers(spark, 0, 0), "files", path, topic="a")
    write_records(_numbers(spark, 100, 250, "CASE WHEN id < 220 THEN 0 ELSE 7 END").repartition(4), "files", path, topic="a", order_by=by_number)
    found = _held(read_backlog(spark, "files", path).where("topic = 'a'"))
    ids = {p: [*range(p, 100, 3)] for p in range(3)}
    ids[0] += range(100, 220)
    ids[7] = list(range(220, 250))
    assert found == sorted((p, offset, i) for p, held in ids.items() for offset, i in enumerate(held))
    assert rows(partition_ends(spark, path).where("topic = 'b'")) == [("b", 0, 4), ("b", 1, 3), ("b", 2, 3)]


def test_offset_ranges_open_only_the_writes_they_need(spark, folder):
    path = os.path.join(folder, "records")
    by_number = F.col("key").cast("string").cast("long")
    for n in range(4):
        write_records(_numbers(spark, 100 * n, 100 * n + 100, "id % 2"), "files", path, topic="t", order_by=by_number)
    start, end = {"t": {0: 60, 1: 70}}, {"t": {0: 90, "1": 71}}
    found = read_backlog(spark, "files", path, start=start, end=end)
    assert _held(found) == sorted([(0, o, 2 * o) for o in range(60, 90)] + [(1, 70, 141)])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(write" in plan and "GreaterThanOrEqual(offset,60)" in plan
    text = backlog_options("kafka", servers="h:1", topic="t", start=start, end=end)
    assert text["startingOffsets"] == '{"t": {"0": 60, "1": 70}}' and text["endingOffsets"] == '{"t": {"0": 90, "1": 71}}'
    same = read_backlog(spark, "files", path, start=text["startingOffsets"], end=text["endingOffsets"])
    assert _held(same) == _held(found)
    rest = read_backlog(spark, "files", path, start={"t": {0: LATEST, 1: 195}})
    assert _held(rest) == [(1, o, 2 * o + 1) for o in range(195, 200)]
    assert read_backlog(spark, "files", path, start={"t": {0: LATEST, 1: LATEST}}).count() == 0


def test_streams_start_at_offsets_and_keep_to_the_cap(spark, folder):
    path = os.path.join(folder, "records")
    write_records(_numbers(spark, 0, 40, "id % 2"), "files", path, topic="t", records_per_file=5, order_by=F.col("key").cast("string").cast("long"))
    sizes = []
    arriving = stream_records(spark, "files", path, start={"t": {0: 15, 1: LATEST}}, per_trigger=5)
    table = BatchTable(spark, os.path.join(folder, "out"))
    drain(for_each_batch(arriving, lambda batch, n: (sizes.append(batch.count()), table(batch, n)), checkpoint=f"{folder}/checkpoint"))
    assert max(sizes) <= 5 and len(sizes) >= 8
    assert _held(table.all_batches()) == [(0, o, 2 * o) for o in range(15, 20)]
    # What is written after "latest" arrives.
    late = stream_records(spark, "files", path, start="latest")
    write_records(_numbers(spark, 40, 44, "id % 2"), "files", path, topic="t", records_per_file=5, order_by=F.col("key").cast("string").cast("long"))
    assert _held(append_result(late)) == [(0, 20, 40), (0, 21, 42), (1, 20, 41), (1, 21, 43)]
    with pytest.raises(ValueError, match="exceeds the cap"):
        stream_records(spark, "files", path, per_trigger=4)


def test_named_start_offsets_cost_a_micro_batch_no_join(spark, folder):
    """Stated offsets are a filter of the scan; partitions not named come from their first record on."""
    path = os.path.join(folder, "records")
    write_records(_numbers(spark, 0, 30), "files", path, topic="t", records_per_file=3, order_by=F.col("key").cast("string").cast("long"))
    table = BatchTable(spark, os.path.join(folder, "out"))
    arriving = stream_records(spark, "files", path, start={"t": {0: 5, 1: LATEST}, "other": {2: 4}}, per_trigger=3)
    query = drain(for_each_batch(arriving, table))
    assert _held(table.all_batches()) == [(0, o, 3 * o) for o in range(5, 10)] + [(2, o, 3 * o + 2) for o in range(10)]
    assert "Join" not in query._jsq.explainInternal(False)


def test_a_long_run_of_micro_batches_compacts_its_log_seldom(spark, folder):
    """The whole log of files is not rewritten every ten micro-batches."""
    path, checkpoint = os.path.join(folder, "records"), os.path.join(folder, "checkpoint")
    write_records(_numbers(spark, 0, 12, "0"), "files", path, topic="t", records_per_file=1)
    drain(for_each_batch(stream_records(spark, "files", path, per_trigger=1), lambda batch, n: None, checkpoint=checkpoint))
    held = os.listdir(os.path.join(checkpoint, "sources", "0"))
    assert "11" in held and not [name for name in held if name.endswith(".compact")]


def test_many_small_files_are_full_and_spread_evenly_over_the_writers(spark, folder):
    """Each task opens as many files, of records next to each other, and only the last file is not full."""
    path = os.path.join(folder, "records")
    by_number = F.col("key").cast("string").cast("long")
    write_records(_numbers(spark, 0, 200, "CASE WHEN id < 150 THEN 0 ELSE id % 3 END"), "files", path, topic="t", records_per_file=3, order_by=by_number)
    write_records(_numbers(spark, 200, 301, "id % 2"), "files", path, topic="t", records_per_file=3, order_by=by_number)
    place, held = {p: 0 for p in range(3)}, []
    for i in range(301):
        p = 0 if i < 150 else i % 3 if i < 200 else i % 2
        held.append((p, place[p], i))
        place[p] += 1
    assert _held(read_backlog(spark, "files", path)) == sorted(held)
    for write, total in ((1, 200), (2, 101)):
        files = spark.read.parquet(f"{path}/write={write}").select("*", F.col("_metadata.file_name").alias("file"))
        sizes = sorted(n for _, n in rows(files.groupBy("file").agg(F.count(F.lit(1)))))
        assert sizes == [total % 3] + [3] * (total // 3)
        writers = 4 * spark.sparkContext.defaultParallelism
        opened = rows(files.groupBy(F.substring("file", 1, 10).alias("task")).agg(F.countDistinct("file").alias("n")).select("n"))
        assert len(opened) == writers and max(opened)[0] - min(opened)[0] <= 1
        assert files.groupBy("file", "partition").agg((F.max("offset") - F.min("offset") + 1 - F.count(F.lit(1))).alias("gaps")).where("gaps > 0").count() == 0


def test_checkpoints_on_a_local_disk_are_plain_files(spark, folder, monkeypatch):
    """No program is run for a rename there; a shared store, and an owner's choice, keep their way."""
    name, ours = next(iter(LOCAL_SETTINGS.items()))
    assert pin_session(spark.newSession()).conf.get(name) == spark.conf.get(name) == ours
    chosen = spark.newSession()
    chosen.conf.set(name, ours.replace("FileSystemBased", "FileContextBased"))
    assert pin_session(chosen).conf.get(name) != ours
    monkeypatch.setattr("tidemark.session.has_local_scratch", lambda _: False)
    assert pin_session(spark.newSession()).conf.get(name, None) is None
    path, checkpoint = os.path.join(folder, "records"), os.path.join(folder, "checkpoint")
    write_records(_numbers(spark, 0, 4, "0"), "files", path, topic="t", records_per_file=1)
    tables = []
    for session in (spark, chosen):     # the same checkpoint, taken up another way
        table = BatchTable(session, os.path.join(folder, f"out{len(tables)}"))
        drain(for_each_batch(stream_records(session, "files", path, per_trigger=1), table, checkpoint=checkpoint))
        if not tables:
            assert len(os.listdir(f"{checkpoint}/commits")) == 8        # a file and its checksum each
        tables.append(table)
        write_records(_numbers(spark, 4, 6, "0"), "files", path, topic="t", records_per_file=1)
    assert [len(_held(t.all_batches())) for t in tables] == [4, 2]


def test_a_small_micro_batch_is_written_in_few_files(spark, folder):
    out = os.path.join(folder, "out")
    table = BatchTable(spark, out)
    table(spark.range(0, 100, 1, 8), 0)
    assert sorted(name[:4] for name in os.listdir(f"{out}/batch=0") if not name.startswith(".")) == ["part", "part"]
    table(spark.range(0, 1_000_000, 1, 8), 1)
    assert len([name for name in os.listdir(f"{out}/batch=1") if name.startswith("part")]) == 8
    assert rows(table.all_batches().groupBy("batch").agg(F.count(F.lit(1)), F.sum("id"))) == [
        (0, 100, 4950), (1, 1_000_000, 499999500000)]


def test_a_write_that_dies_leaves_a_gap_and_no_offset_twice(spark, folder):
    path = os.path.join(folder, "records")
    write_records(_numbers(spark, 0, 4, "0"), "files", path, topic="t")
    bad = _numbers(spark, 4, 8, "0").withColumn("value", F.expr("CASE WHEN key = X'36' THEN CAST(raise_error('lost') AS BINARY) ELSE value END"))
    with pytest.raises(Exception, match="lost"):
        write_records(bad, "files", path, topic="t")
    write_records(_numbers(spark, 8, 10, "0"), "files", path, topic="t")
    offsets = [o for _, o, _ in _held(read_backlog(spark, "files", path))]
    assert len(set(offsets)) == len(offsets) == 6


def test_schema_of_payloads_is_merged_in_one_pass(spark):
    texts = ['{"a": 1, "b c": {"x": [1, 2.5]}, "OBJECT": true}', '{"a": 2.5, "n": null}', '{"b c": {"y": "t", "x": []}}', "broken", "[1]", "7", None,
             '{"a": 12345678901234567890123, "mixed": 1, "empty": {}}', '{"mixed": "text", "last": "only here"}']
    df = spark.createDataFrame([(t,) for t in texts], "value STRING")
    seen = infer_schema(df, "value")
    assert seen == T.StructType.fromDDL("OBJECT BOOLEAN, a DOUBLE, `b c` STRUCT<x: ARRAY<DOUBLE>, y: STRING>, empty STRING, last STRING, mixed STRING, n STRING")
    assert infer_schema(df.where("value = '7'"), "value") == T.StructType([])
    assert infer_schema(df.limit(0), "value", declared="k INT") == T.StructType.fromDDL("k INT")
    plan = merged_schema(df.repartition(4), "value")._jdf.queryExecution().executedPlan().toString()
    assert "partial_schema_of_variant_agg" in plan and plan.count("Scan") == 1
    assert value_schema("OBJECT<a: ARRAY<VOID>, v: VARIANT, d: DATE, t: TIMESTAMP_NTZ>") == T.StructType.fromDDL(
        "a ARRAY<STRING>, v STRING, d DATE, t TIMESTAMP_NTZ")
