import hashlib
import math

import pytest
from pyspark.sql import functions as F

from netsieve.operators import features, lookups, profile, split, state, weights
from netsieve.operators.sizing import scratch_path, small_table
from netsieve.plans import telemetry


@pytest.fixture(scope="module")
def unified(spark, small):
    return telemetry.unified_view(spark, small)


def test_positions_agree(spark):
    words = ["", "G", "GE", "GET", "GETS", "PO", "POST", "été", "a", "Z"]
    counts = spark.createDataFrame([(w, n + 1) for n, w in enumerate(words)], "value string, n long")
    expected = {w: n for n, w in enumerate(sorted(words), start=1)}
    for form in (state._small_positions(counts), state._large_positions(counts)):
        assert {r.value: r.position for r in form.collect()} == expected


def test_codes_skip_the_empty_value(spark):
    counts = spark.createDataFrame([("", 2), ("GET", 1), ("POST", 1)], "value string, n long")
    rows = {r.value: (r.code, r.frequency) for r in state.category_table(counts).collect()}
    assert rows == {"": (None, 0.5), "GET": (2, 0.25), "POST": (3, 0.25)}


def test_small_table_refuses_large_ones(spark):
    assert small_table(spark.range(11), 10) is None
    assert small_table(spark.range(10), 10).count() == 10


def test_lookup_forms_agree_on_a_hot_key(spark):
    """One key holds a third of the rows, many occur once, some are unknown."""
    ids = spark.range(30_000)
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    rows = ids.withColumn("k", F.coalesce(key, F.concat(F.lit("single"), F.col("id").cast("string"))))
    table = rows.filter("id < 20000").groupBy(F.col("k").alias("key")).agg(F.count("*").alias("count")).filter("count >= 2")
    forms = {
        "lazy": {}, "broadcast": {"size": (10, 100), "total": 20_000},
        "shuffled": {"size": (1 << 40, 1 << 50), "total": 20_000},
        "all light": {"size": (1 << 40, 1 << 50), "total": 1 << 60},
    }
    found = {}
    for name, options in forms.items():
        joined = lookups.lookup_key(rows, F.col("k"), table, {"n": "count"}, **options)
        assert joined.columns == ["id", "k", "n"]
        found[name] = sorted(map(tuple, joined.collect()), key=lambda r: r[0])
    assert len(found["lazy"]) == 30_000
    assert all(result == found["lazy"] for result in found.values())


def test_hot_rows_are_spread_over_the_shuffle(spark):
    rows = spark.range(0, 8000, 1, 8).withColumn("k", F.lit("hot"))
    table = spark.createDataFrame([("hot", 8000), ("cold", 2)], "key string, count long")
    joined = lookups.lookup_key(rows, F.col("k"), table, {"n": "count"}, size=(1 << 40, 1 << 50), total=8000)
    assert joined.filter("n = 8000").count() == 8000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SPARK_PARTITION_ID" in plan


def test_stored_state_gives_the_same_features(spark, unified):
    stored = state.fit_to(unified, scratch_path(spark, "state"))
    assert stored.total == unified.count()
    assert stored.sizes["sources"][0] == stored.sources.count()
    lazy = features.fit_transform(unified, ["event_id"])
    loaded = features.transform(unified, stored, ["event_id"])
    assert lazy.exceptAll(loaded).count() == 0 and loaded.count() == lazy.count()


def test_feature_selection_reports_missing_names(spark):
    with pytest.raises(ValueError, match="payload_present"):
        features.select_features(spark.range(1).withColumnRenamed("id", "src_port"))


def test_kept_columns_pass_through(unified, spark):
    stored = state.fit_to(unified, scratch_path(spark, "state"))
    table = features.transform(unified, stored, ["event_id", "label", "source_name", "bytes"])
    assert table.columns[:3] == ["event_id", "label", "source_name"] and len(table.columns) == 50


# --- splits ---------------------------------------------------------------------------------


def brute_force_split(rows, seed=42):
    """(key, label) rows in hash order per label, quotas by largest remainder."""
    def share(wanted, sizes):
        total = sum(sizes.values())
        exact = {k: wanted * n / total for k, n in sizes.items()}
        base = {k: math.floor(v) for k, v in exact.items()}
        left = wanted - sum(base.values())
        for k in sorted(exact, key=lambda k: (-(exact[k] - base[k]), k))[: int(left)]:
            base[k] += 1
        return base

    sizes = {}
    for _, label in rows:
        sizes[label] = sizes.get(label, 0) + 1
    test = share(math.ceil(len(rows) * 0.15), sizes)
    rest = {k: n - test[k] for k, n in sizes.items()}
    validation = share(math.ceil(sum(rest.values()) * (0.15 / 0.85)), rest)
    parts = {}
    for label in sizes:
        keys = sorted((hashlib.md5(f"{k}:{seed}".encode()).hexdigest(), k) for k, l in rows if l == label)
        for rank, (_, key) in enumerate(keys):
            parts[key] = "test" if rank < test[label] else "validation" if rank < test[label] + validation[label] else "train"
    return parts


@pytest.mark.parametrize("count, positive", [(1000, 5), (7, 2), (3, 3), (501, 1)])
def test_split_equals_brute_force(spark, count, positive):
    rows = [(n, 1 if n % positive == 0 else 0) for n in range(count)]
    frame = spark.createDataFrame(rows, "key long, label int")
    found = {r.key: r.split for r in split.stratified_split(frame, ["key"]).collect()}
    assert found == brute_force_split(rows)


def test_copies_stay_together(spark):
    """A third of all rows share one key."""
    rows = [(n if n % 3 else -1, n % 2) for n in range(3000)]
    frame = spark.createDataFrame(rows, "key long, label int")
    parts = split.stratified_split(frame, ["key"])
    assert parts.count() == 3000
    assert parts.filter("key = -1").groupBy("label").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0
    assert {r.split for r in parts.select("split").distinct().collect()} == {"train", "validation", "test"}


def test_selection_subset(spark):
    frame = spark.range(1000).select(F.col("id").alias("key"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    assert split.selection_subset(frame, ["key"], 1000).count() == 1000
    kept = split.selection_subset(frame, ["key"], 333)
    assert {r.label: r["count"] for r in kept.groupBy("label").count().collect()} == {0: 300, 1: 33}


def test_default_row_key_is_the_whole_record(unified):
    parts = split.stratified_split(unified.drop("event_id"))
    assert profile.split_rows(parts).filter("split = 'test'").first().rows > 0


def test_weights_average_to_one(unified):
    row = weights.with_sample_weights(unified).agg(F.avg("weight").alias("w"), F.count("*").alias("n")).first()
    assert row.w == pytest.approx(1.0, abs=1e-5) and row.n == unified.count()


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_split_and_weights_move_no_wide_row(spark, adaptive):
    """The wide table meets only broadcast tables: no exchange stands between its scan and the result."""
    frame = spark.range(2000).select(
        "id", (F.col("id") % 2).cast("int").alias("label"), F.concat(F.lit("s"), (F.col("id") % 4).cast("string")).alias("source_name"), F.lit("wide").alias("payload")
    )
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        for out in (split.stratified_split(frame, ["id"]), split.selection_subset(frame, ["id"], limit=500), weights.with_sample_weights(frame)):
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan, plan
            assert "BroadcastHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
