"""Topics: stable offsets, pruned reads, committed readers."""

import threading

from pyspark.sql import functions as F

from ebbtide.session import scratch_path
from ebbtide.sources import topics
from ebbtide.streaming import events as ev

FIELDS = "customer_id string, value double"


def deliver(spark, path, values, parts=2):
    rows = spark.createDataFrame([(f"c{v}", float(v)) for v in values], FIELDS).repartition(parts)
    topics.produce(rows, path)


def test_reads_open_only_the_files_they_need(spark):
    path = scratch_path(spark, "pruned topic")
    for k in range(4):
        deliver(spark, path, range(100 * k, 100 * k + 100))
    index = topics.offset_index(spark, path)
    assert [d.first for d in index if d.n] == sorted(d.first for d in index if d.n) and sum(d.n for d in index) == 400
    rest = topics.read_topic(spark, path, FIELDS, 250)
    assert sorted(r["offset"] for r in rest.collect()) == list(range(250, 400))
    assert len(rest.inputFiles()) <= 5 < len([d for d in index if d.n])
    last = topics.latest(spark, path, FIELDS, 30)
    assert [r["offset"] for r in last.collect()] == list(range(399, 369, -1)) and len(last.inputFiles()) == 1
    assert topics.topic_count(spark, path).first()["n"] == 400


def test_offsets_stay_when_files_are_added_and_blank_lines_keep_theirs(spark):
    path = scratch_path(spark, "topic")
    deliver(spark, path, range(10), 1)
    before = {r["customer_id"]: r["offset"] for r in topics.read_topic(spark, path, FIELDS).collect()}
    spark.createDataFrame([("",), ('{"customer_id": "bare", "value": 2.0}',), ("  ",)], "value string").coalesce(1).write.text(f"{path}/00-sorts-first")
    after = {r["customer_id"]: r["offset"] for r in topics.read_topic(spark, path, FIELDS).collect()}
    assert after == {**before, "bare": 11} and topics.topic_count(spark, path).first()["n"] == 11
    topics.purge(spark, path)
    assert topics.offset_index(spark, path)[-1].first == 0 and topics.read_topic(spark, path, FIELDS).count() == 0


def test_a_file_of_many_blocks_is_numbered_line_by_line(spark):
    path = scratch_path(spark, "blocks")
    deliver(spark, path, range(3000), 1)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = topics.read_topic(spark, path, FIELDS, 1234)
        assert [(r["offset"], r["value"]) for r in found.orderBy("offset").collect()] == [(k, float(v)) for k, v in enumerate(order(spark, path)) if k >= 1234]
        assert found.rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def order(spark, path):
    """Values in the order of the file's lines."""
    text = "".join(v for _, v in sorted(spark.sparkContext.wholeTextFiles(f"{path}/*").collect()))
    return [float(line.split('"value":')[2].rstrip("}")) for line in text.splitlines()]


def test_readers_commit_and_go_on_where_they_were(spark):
    path = scratch_path(spark, "readers")
    deliver(spark, path, range(20))
    seen = []

    def handle(messages, first, end):
        seen.append((first, end, messages.count()))

    assert topics.process_new(spark, path, FIELDS, "scores", handle, most=5) == 20
    assert sum(n for _, _, n in seen) == 20 and [a for a, _, _ in seen][1:] == [b for _, b, _ in seen][:-1]
    deliver(spark, path, range(20, 25), 1)

    def broken(messages, first, end):
        raise RuntimeError("lost")

    try:
        topics.process_new(spark, path, FIELDS, "scores", broken)
    except RuntimeError:
        pass
    assert topics.committed_offset(spark, path, "scores") == 20  # as after a restart
    seen.clear()
    assert topics.process_new(spark, path, FIELDS, "scores", handle) == 25 and seen == [(20, 25, 5)]
    assert topics.process_new(spark, path, FIELDS, "other", handle) == 25


def test_two_indexers_agree(spark):
    path = scratch_path(spark, "two")
    deliver(spark, path, range(50), 4)
    found = []
    both = [threading.Thread(target=lambda: found.append(topics.offset_index(spark, path))) for _ in range(2)]
    for t in both:
        t.start()
    for t in both:
        t.join()
    assert found[0] == found[1] == topics.offset_index(spark, path) and sum(d.n for d in found[0]) == 50
    assert topics.read_topic(spark, path, FIELDS).agg(F.count_distinct("offset")).first()[0] == 50


def test_lines_of_byte_ranges_are_each_read_once():
    import io

    from ebbtide.sources.topic_stream import lines_from

    text = b"a\n\nbcd\n\xc3\xa4\n" + b"x" * 20 + b"\nlast"
    for cuts in ([5], [1, 2, 3], [2, 7, 9, 11], list(range(1, len(text)))):
        bounds = list(zip([0, *cuts], [*cuts, None]))
        assert [x for a, z in bounds for x in lines_from(io.BytesIO(text), a, z)] == text.split(b"\n"), cuts


def test_a_stream_starts_at_an_offset_and_goes_on_after_a_restart(spark):
    path, out, checkpoint = scratch_path(spark, "streamed topic"), scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    for k in range(3):
        deliver(spark, path, range(100 * k, 100 * k + 100))

    def run(from_offset):
        done = ev.run_available(topics.stream_from(spark, path, FIELDS, from_offset), out, checkpoint, spark)
        return {r["offset"]: r["value"] for r in done.collect()}

    read = {r["offset"]: r["value"] for r in topics.read_topic(spark, path, FIELDS).collect()}
    assert run(150) == {k: v for k, v in read.items() if k >= 150}
    deliver(spark, path, range(300, 400))
    topics.offset_index(spark, path)
    done = run(0)  # the checkpoint holds, not the new start
    assert sorted(done) == list(range(150, 400)) and spark.read.parquet(out).count() == 250


def test_stream_partitions_are_the_blocks_of_the_range(spark):
    from ebbtide.sources.topic_stream import TopicReader

    path = scratch_path(spark, "blocks")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        deliver(spark, path, range(200), 1)
        index = topics.offset_index(spark, path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    reader = TopicReader(f"{path}/{topics.INDEX}", 0)
    assert len(index[-1].blocks) > 5 and reader.latestOffset() == {"offset": 200}
    parts = reader.partitions({"offset": 120}, {"offset": 130})
    assert len(parts) < len(index[-1].blocks) / 2
    assert [o for p in parts for b in reader.read(p) for o in b.column(0).to_pylist()] == list(range(120, 130))
    whole = [v for p in reader.partitions({"offset": 0}, {"offset": 200}) for b in reader.read(p) for v in b.column(1).to_pylist()]
    assert whole == [r["value"] for r in spark.read.text(path, recursiveFileLookup=True).collect()]
