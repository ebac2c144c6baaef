"""Fitted state above the broadcast limit: buckets, wanted keys, two passes of counting, ranks."""

import pytest
from pyspark.sql import functions as F

from netsieve.operators import features, lookups, scoring, state
from netsieve.operators.sizing import scratch_path
from netsieve.plans import telemetry


@pytest.fixture(scope="module")
def unified(spark, small):
    return telemetry.unified_view(spark, small)


@pytest.fixture()
def nothing_is_small(monkeypatch):
    monkeypatch.setattr(state, "BROADCAST_ROWS", 1)
    yield


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def files_read(spark, frame):
    """Files that the scan opens: with a high cost of opening each is a partition of its own."""
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 27))
    try:
        return frame.select("*").rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.fixture()
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_large_state_is_read_in_its_buckets(spark, unified, nothing_is_small, no_auto_broadcast):
    path = scratch_path(spark, "state")
    state.fit_to(unified, path)
    spark.sql("DROP TABLE " + state._table_name(state.qualified(spark, path + "/by-digest/src_dst")))
    again = state.load_state(spark, path)  # as another session finds it
    rows = spark.createDataFrame(unified.limit(300).collect(), unified.schema)
    found = lookups.lookup_key(rows.withColumn("k", F.concat("src_ip", F.lit("->"), "dst_ip")), F.col("k"), again.counts["src_dst"], {"n": "count"}, again.sizes["src_dst"], 1 << 60)
    plan = plan_of(found)
    join = plan[plan.index("SortMergeJoin") :]
    assert "Bucketed: true" in plan and "SelectedBucketsCount" in plan
    table_side = [line for line in join.split("\n") if "hashpartitioning(_found" in line]
    assert not table_side, plan  # only records move
    expected = features.transform(rows, state.fit(unified), ["event_id"])
    got = features.transform(rows, again, ["event_id"])
    assert got.exceptAll(expected).count() == 0 and got.count() == expected.count()


def test_a_batch_asks_for_its_keys_only(spark, unified, nothing_is_small, monkeypatch):
    stored = state.fit_to(unified, scratch_path(spark, "state"))
    rows = spark.createDataFrame(unified.limit(40).collect(), unified.schema)
    own = lookups.narrowed(stored, rows, "uri")
    for kind in state.COUNT_KINDS:
        assert own.counts[kind].count() <= own.sizes[kind][0] <= 80
    one = lookups.narrowed(stored, rows.limit(1)).counts["request"]
    assert files_read(spark, one) <= 1 < files_read(spark, stored.counts["request"])
    scored = [scoring.score_both_views(rows, s, scoring.rule_scorer, ["event_id"], "uri").orderBy("event_id").collect() for s in (stored, own)]
    assert scored[0] == scored[1] and scored[0]
    monkeypatch.setattr(lookups, "WANTED_KEYS", 1)
    assert lookups.narrowed(stored, rows) is stored
    monkeypatch.setattr(state, "BROADCAST_ROWS", 1 << 40)
    assert lookups.narrowed(stored, rows) is stored


def test_constants_are_recorded(spark, unified):
    stored = state.fit_to(unified, scratch_path(spark, "state"))
    assert stored.constants and lookups._web_constants(stored) == lookups._web_constants(state.fit(unified))


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_keys_seen_once_go_before_the_shuffle(spark, unified, monkeypatch, limit):
    """By marks and by bit table: the counts are those of a plain aggregation."""
    monkeypatch.setattr(state, "SEEN_ROWS", limit)
    monkeypatch.setattr(state, "MAX_BITS", 1 << 16)
    keys = state.keyed(unified)
    expected = {(kind, r.key, r["count"]) for kind in state.COUNT_KINDS for r in state.count_table(keys, kind).collect()}
    assert {tuple(r) for r in state.all_key_counts(unified, two_passes=True).collect()} == expected and expected


def shuffled_bytes(spark, job):
    """Bytes of shuffle that a job writes."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def last():
        n = 0
        while True:
            try:
                store.lastStageAttempt(n)
            except Exception:
                return n
            n += 1

    first = shuffled_bytes.known if hasattr(shuffled_bytes, "known") else last()
    first = max(first, last())
    job()
    end = last()
    shuffled_bytes.known = end
    return sum(store.lastStageAttempt(n).shuffleWriteBytes() for n in range(first, end))


def test_two_passes_shuffle_less_where_most_keys_occur_once(spark):
    ids = spark.range(0, 80_000, 1, 8)
    text = F.concat(F.lit("/path/"), F.sha2(F.col("id").cast("string"), 256), F.lit("?q="), F.sha2((F.col("id") + 1).cast("string"), 256))
    rows = ids.select(
        F.concat(F.lit("10.0."), (F.col("id") % 200).cast("string")).alias("src_ip"), F.lit("10.9.9.9").alias("dst_ip"), F.lit(1).alias("src_port"), F.lit(80).alias("dst_port"),
        F.lit("HTTP").alias("protocol"), *[F.lit(1.0).cast("float").alias(c) for c in ("bytes", "packets", "duration")], F.lit("GET").alias("http_method"), text.alias("uri"),
    )
    found = {}
    moved = {}
    for two in (False, True):
        moved[two] = shuffled_bytes(spark, lambda: found.update({two: sorted(map(tuple, state.all_key_counts(rows, two).collect()))}))
    assert found[True] == found[False] and found[True]
    assert 0 < moved[True] <= moved[False] / 3, moved


def test_bit_table_drops_what_is_seen_once(spark, monkeypatch):
    monkeypatch.setattr(state, "SEEN_ROWS", 0)
    keys = spark.range(20_000).select(F.lit("dst").alias("kind"), F.when(F.col("id") < 100, "hot").otherwise(F.col("id").cast("string")).alias("key"))
    keys = keys.withColumn("mark", F.xxhash64("kind", "key"))
    marks = state.repeated_marks(keys)
    assert marks.count() == 1
    kept = state.seen_again(keys, marks, 1)
    assert kept.columns == keys.columns and kept.filter("key = 'hot'").count() == 100 and kept.count() < 110
    other = spark.range(5000).select(F.xxhash64("id").alias("mark"))
    assert state.seen_again(other, other, 5000).count() == 5000  # no mark is lost


def test_ranks_of_many_values_with_one_prefix(spark):
    counts = spark.range(100_000).select(F.concat(F.lit("prefix-"), F.md5(F.col("id").cast("string"))).alias("value"), F.lit(1).cast("long").alias("n"))
    large = state._large_positions(counts)
    assert large.join(state._small_positions(counts).withColumnRenamed("position", "p"), "value").filter("position = p").count() == 100_000
    folders = {f.rsplit("/", 1)[0] for f in large.inputFiles()}
    ranges = [r["count"] for r in spark.read.parquet(*folders).groupBy(F.shiftright("id", 33)).count().collect()]
    assert len(ranges) > 1 and max(ranges) < 100_000 == sum(ranges)


def test_hot_categories_and_long_keys(spark):
    rows = spark.range(3000).withColumn("v", F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))))
    table = state.category_table(rows.groupBy(F.col("v").alias("value")).agg(F.count(F.lit(1)).alias("n")))
    forms = [lookups.lookup_category(rows, F.col("v"), table, {"code": "code", "share": "frequency"}, size) for size in (None, (1, 1), (1 << 40, 1 << 50))]
    found = [sorted(map(tuple, form.collect())) for form in forms]
    assert found[0] == found[1] == found[2] and "SPARK_PARTITION_ID" in plan_of(forms[2])
    long = spark.createDataFrame([("x" * 5000, 7), ("y", 2)], "key string, count long")
    asked = spark.createDataFrame([("x" * 5000,), ("z",)], "k string")
    assert {(r.k[:1], r.n) for r in lookups.lookup_key(asked, F.col("k"), long, {"n": "count"}, (1 << 40, 1 << 50), 7).collect()} == {("x", 7), ("z", None)}
