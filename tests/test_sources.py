import pytest
from pyspark.sql import functions as F

from ebbtide.sources import files, tables, topics
from ebbtide.vocab import RAW_COLUMNS


def test_topic_offsets_blank_lines_and_bare_values(spark, tmp_path):
    path = str(tmp_path / "t")
    topics.produce(spark.range(5).select(F.concat(F.lit("c"), "id").alias("customer_id"), F.lit("login").alias("event_type")).coalesce(1), path)
    got = topics.read_topic(spark, path, topics.EVENT, 3).orderBy("offset").collect()
    assert [(r["offset"], r["customer_id"], r["key"]) for r in got] == [(3, "c3", "c3"), (4, "c4", "c4")]
    spark.createDataFrame([("",), ('{"customer_id":"z","event_type":"login"}',)], "value string").coalesce(1).write.text(topics.delivery(path))
    last = topics.latest(spark, path, topics.EVENT, 1).first()
    assert (last["offset"], last["customer_id"], last["key"]) == (6, "z", None)
    assert topics.topic_count(spark, path).first()["n"] == 6
    topics.purge(spark, path)
    assert topics.topic_count(spark, path).first()["n"] == 0


def test_offsets_over_many_small_blocks(spark, tmp_path):
    path = str(tmp_path / "big")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        topics.produce(spark.range(500).orderBy("id").select(F.col("id").cast("string").alias("customer_id")), path)
        got = topics.read_topic(spark, path, "customer_id string")
        assert got.rdd.getNumPartitions() > 1
        assert all(r["offset"] == int(r["customer_id"]) for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_gate_refuses_short_and_incomplete_files(spark, inputs, tmp_path):
    inputs.raw.write.option("header", True).csv(str(tmp_path / "short"))
    with pytest.raises(ValueError, match="too few rows"):
        files.load_raw(spark, str(tmp_path / "short"))
    inputs.raw.drop("Churn").write.option("header", True).csv(str(tmp_path / "narrow"))
    with pytest.raises(ValueError, match="missing required columns"):
        files.load_raw(spark, str(tmp_path / "narrow"))


def test_landing_csv_accepts_short_and_long_lines(spark, tmp_path):
    lines = [",".join(RAW_COLUMNS), "a,Male,1", "b," + ",".join(["x"] * 20) + ",extra,extra"]
    (tmp_path / "f.csv").write_text("\n".join(lines) + "\n")
    out = {r["customerID"]: r for r in files.read_landing_csv(spark, str(tmp_path / "f.csv")).collect()}
    assert out["a"]["SeniorCitizen"] == 1 and out["a"]["Churn"] is None and out["b"]["Churn"] == "x" and out["b"]["tenure"] is None


def test_json_array_file(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"k": 1},\n {"k": 2}]')
    assert sorted(r["k"] for r in files.read_json_array(spark, str(tmp_path / "a.json"), "k int").collect()) == [1, 2]


def test_json_array_file_by_ranges(spark, tmp_path):
    """One file over many byte ranges equals the read in one task, wherever the ranges cut."""
    import json
    import random

    from ebbtide.sources.arrays import read_array_files

    rng = random.Random(5)
    signs = ["{", "}", "[", "]", '"', "\\", ",", ":", "é", "x", "\n", "\\\"}"]
    rows = [
        {"k": i, "s": "".join(rng.choices(signs, k=rng.choice([0, 3, 40, 300]))), "in": {"a": [{"b": j} for j in range(rng.randrange(4))]}}
        for i in range(24)
    ]
    schema = "k int, s string, in struct<a: array<struct<b: int>>>"
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for n, indent in enumerate((None, 2)):
            file = tmp_path / f"{n}.json"
            file.write_text(json.dumps(rows, indent=indent, ensure_ascii=False), encoding="utf-8")
            for size in (211, 1 << 20):
                spark.conf.set("spark.sql.files.maxPartitionBytes", size)
                found = read_array_files(spark, str(file), schema).collect()
                assert sorted((r.asDict(True) for r in found), key=lambda r: r["k"]) == rows, (indent, size)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_json_array_files_at_their_limits(spark, tmp_path):
    """Empty files and arrays, elements that are no objects, a record of another shape, a file that ends early."""
    from ebbtide.sources.arrays import read_array_files, write_array_files

    texts = {"none": "", "empty": "[]\n", "blank": " [ ] ", "mixed": '[1, {"k": 1}, null, {"k": {"z": 1}}, {}]', "cut": '[{"k": 7}, {"k": "a'}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    found = {n: sorted((r["k"] for r in read_array_files(spark, str(tmp_path / f"{n}.json"), "k int").collect()), key=str) for n in texts}
    assert found == {"none": [], "empty": [], "blank": [], "mixed": [1, None, None], "cut": [7]}
    for n in (0, 3):
        write_array_files(spark.range(n).withColumnRenamed("id", "k"), str(tmp_path / f"out{n}"))
        assert read_array_files(spark, str(tmp_path / f"out{n}"), "k int").count() == n


def test_read_or_build_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    assert [tables.read_or_build(spark, str(tmp_path / "x"), build).count() for _ in range(2)] == [3, 3] and len(calls) == 1


def test_load_table_counts(spark, tmp_path):
    path = str(tmp_path / "x")
    assert tables.load_table(spark.range(7), path) == 7
    assert tables.load_table(spark.range(2), path, "append") == 2
    assert spark.read.parquet(path).count() == 9
    assert tables.load_table(spark.range(0), path) == 0


def test_seed_limit_and_level_fallback(spark, inputs):
    customers, subscriptions = tables.seed_customers(inputs.clean, limit=10)
    assert customers.count() == 10 and subscriptions.count() == 10
    unset = inputs.decided.withColumn("risk_level", F.lit(None).cast("string"))
    predictions = tables.seed_decisions(unset, "v1")[0]
    assert predictions.join(inputs.decided, ["customer_id", "risk_level"]).count() == inputs.decided.count()


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from ebbtide import session

    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn"})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Cluster())


def test_co_located_tables_join_without_a_shuffle(spark, inputs, tmp_path):
    from ebbtide.plans.load import store_co_located

    w = store_co_located(inputs.house, str(tmp_path / "b"), "test_", buckets=4)
    joined = w.customers.hint("merge").join(w.predictions, "customer_id").join(w.actions.select("customer_id", "urgency"), "customer_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan and joined.count() == 150


def test_scratch_folder(spark, tmp_path, monkeypatch):
    from ebbtide import session

    monkeypatch.setattr(session, "scratch_root", lambda _spark: str(tmp_path))
    (tmp_path / "other").mkdir()
    assert session.written(spark.range(3), "x").count() == 3
    mine = tmp_path / "ebbtide" / spark.sparkContext.applicationId
    assert mine.exists() and session.release_scratch(spark)
    assert not mine.exists() and (tmp_path / "other").exists()


def test_local_session_without_a_folder_gets_one(spark, monkeypatch):
    from ebbtide import session

    class Conf:
        def get(self, *_):
            return None

    class Local:
        conf = Conf()
        sparkContext = type("C", (), {"master": "local[2]", "applicationId": "test-app"})()

    assert session.scratch_root(Local()) == session.scratch_root(Local())
