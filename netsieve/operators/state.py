"""Fitted state: category codes and key counts learned from a training table.

All of it is kept as tables. ``fit`` gives lazy tables; ``fit_to`` writes them as Parquet in few
passes over the data and ``load_state`` reads them back together with their recorded sizes, which
decide how a lookup joins (see ``lookups``). Tables too large to broadcast are stored a second time,
bucketed and sorted by a 16-byte digest of the key: a join with records moves only the records.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.keys import key_digest, source_key, traffic_keys
from .records import primary_view, with_text
from .sizing import checkpoint_table, claim_file, file_names, qualified, small_table

COUNT_KINDS = ("dst", "src_dst", "endpoint", "request")
MIN_COUNT = 2
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20
BUCKET_ROWS = 1_000_000  # rows of a stored table for one bucket
SEEN_ROWS = 1_000_000  # digests of repeated keys up to which they are broadcast as they are
TWO_PASS_BYTES = 64 << 30  # input from which keys seen once are told apart before any text is shuffled
BITMAP_BITS = 32_768  # one row of a bit table
BITS_PER_KEY = 16
MAX_BITS = 1 << 28  # of a bit table: 32 MB
CATEGORIES = ("protocol", "http_method")
# What all web-payload views of requests share: (table, key) and the values read there.
WEB_SOURCE, WEB_TARGET = "NO_SRC::HTTP", "NO_DST::HTTP::0"
WEB_LOOKUPS = {
    "protocol": ("HTTP", {"protocol_code": "code", "protocol_frequency": "frequency"}),
    "http_method": ("GET", {"http_method_code": "code", "http_method_frequency": "frequency"}),
    "sources": (WEB_SOURCE, {"src": "count", "ports": "ports"}),
    "dst": (WEB_TARGET, {"dst": "count"}),
    "src_dst": (f"{WEB_SOURCE}->{WEB_TARGET}", {"src_dst": "count"}),
}
COLUMNS = {
    **{name: "value string, code int, frequency double" for name in CATEGORIES},
    "sources": "key string, count long, ports long",
    **{kind: "key string, count long" for kind in COUNT_KINDS},
}


@dataclass(frozen=True)
class FeatureState:
    """protocol/http_method: (value, code, frequency); sources: (key, count, ports); counts: (key, count).

    ``sizes`` is known for stored state only: table -> (rows, key bytes). ``total`` is the number of
    fitted rows, ``constants`` what ``WEB_LOOKUPS`` found. Large stored tables have a ``digest`` too.
    """

    protocol: DataFrame
    http_method: DataFrame
    sources: DataFrame
    counts: dict[str, DataFrame]
    total: int | None = None
    sizes: dict[str, tuple[int, int]] = field(default_factory=dict)
    constants: dict[str, float] | None = None

    def table(self, name: str) -> DataFrame:
        return self.counts[name] if name in self.counts else getattr(self, name)


def fits_broadcast(size: tuple[int, int] | None) -> bool:
    return size is not None and size[0] <= BROADCAST_ROWS and size[1] <= BROADCAST_BYTES


def keyed(frame: DataFrame) -> DataFrame:
    """Only the columns that fitting needs: categories, destination port and the five keys."""
    record = primary_view()
    keys = traffic_keys(record)
    return with_text(frame).select(
        record["protocol"].alias("protocol"),
        record["http_method"].alias("http_method"),
        record["dst_port"].alias("dst_port"),
        *[key.alias(kind) for kind, key in keys.items()],
    )


def value_counts(values: DataFrame, column: str) -> DataFrame:
    return values.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def category_table(counts: DataFrame) -> DataFrame:
    """(value, n) -> (value, code, frequency).

    The code is the position in the sorted list of distinct values, the empty text included; the
    empty text itself has a frequency but no code.
    """
    small = small_table(counts)
    positions = _small_positions(small) if small is not None else _large_positions(counts)
    rows = small if small is not None else counts
    total = rows.agg(F.sum("n")).first()[0] or 0
    return positions.select(
        "value",
        F.when(F.col("value") != "", F.col("position")).cast("int").alias("code"),
        (F.col("n") / F.lit(float(max(total, 1)))).alias("frequency"),
    )


def _small_positions(counts: DataFrame) -> DataFrame:
    return counts.withColumn("position", F.row_number().over(W.orderBy("value")))


def _large_positions(counts: DataFrame) -> DataFrame:
    """Global rank without one sorted task: ranges of values, the rows before each range, the place inside.

    The ranged table is written, as ranges are sampled and a second run could cut elsewhere. Ids of rows hold
    range and place; only the number of rows of each range is summed in one place.
    """
    ranged = counts.repartitionByRange("value").sortWithinPartitions("value").withColumn("id", F.monotonically_increasing_id())
    ranged = checkpoint_table(ranged, "ranked-values")
    ranged = ranged.select("value", "n", F.shiftright("id", 33).alias("range"), F.col("id").bitwiseAND(F.lit((1 << 33) - 1)).alias("inside"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("size"))
    offsets = offsets.select("range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))  # one row for each range
    return ranged.join(F.broadcast(offsets), "range").select("value", "n", (F.col("offset") + F.col("inside") + 1).alias("position"))


def source_table(frame: DataFrame) -> DataFrame:
    """(key, count, ports) per source. Ports are counted per (source, port) first, so a source with
    most of the rows leaves at most 65,536 rows for the second step."""
    record = primary_view()
    per_port = (
        frame.select(source_key(record).alias("key"), record["dst_port"].alias("port"))
        .groupBy("key", "port")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_port.groupBy("key").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("ports")
    )


def count_table(keys: DataFrame, kind: str) -> DataFrame:
    """(key, count) for keys seen at least twice."""
    return (
        keys.groupBy(F.col(kind).alias("key"))
        .agg(F.count(F.lit(1)).alias("count"))
        .filter(F.col("count") >= MIN_COUNT)
    )


def fit(frame: DataFrame) -> FeatureState:
    """Lazy state of a table, to look at. What looks keys up calls :func:`fit_to`: stored tables have a known size, and hot keys are split off."""
    keys = keyed(frame)
    return FeatureState(
        protocol=category_table(value_counts(keys, "protocol")),
        http_method=category_table(value_counts(keys, "http_method")),
        sources=source_table(frame),
        counts={kind: count_table(keys, kind) for kind in COUNT_KINDS},
    )


def _kind_keys(frame: DataFrame) -> DataFrame:
    """(kind, key) of the four remaining kinds, and ``mark``, 64 bits that stand for both."""
    keys = keyed(frame)
    pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("key")) for kind in COUNT_KINDS])
    return keys.select(F.inline(pairs)).withColumn("mark", F.xxhash64("kind", "key"))


def repeated_marks(keys: DataFrame) -> DataFrame:
    """Marks that occur twice or more: keys seen once are told apart by 8 bytes, and their text is not shuffled."""
    return keys.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_COUNT).select("mark")


def seen_again(keys: DataFrame, marks: DataFrame, rows: int) -> DataFrame:
    """The rows whose mark is among ``marks``, and a few more beyond ``SEEN_ROWS`` marks, where a bit table of at most ``MAX_BITS`` bits is
    broadcast instead of them. Only a table of more keys than it has bits lets most rows through; counts are exact in any case."""
    if rows <= SEEN_ROWS:
        return keys.join(F.broadcast(marks), "mark", "left_semi")
    bits = BITMAP_BITS
    while bits < min(MAX_BITS, rows * BITS_PER_KEY):
        bits *= 2
    place = F.pmod("mark", F.lit(bits))
    slot, bit = F.shiftright(place, 15), place.bitwiseAND(F.lit(BITMAP_BITS - 1))
    table = marks.select(slot.alias("slot"), bit.alias("bit")).groupBy("slot").agg(F.bitmap_construct_agg("bit").alias("bits"))
    at = keys.withColumns({"_slot": slot, "_bit": bit}).join(F.broadcast(table), F.col("_slot") == F.col("slot"))
    byte = F.conv(F.hex(F.substring("bits", (F.shiftright("_bit", 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return at.filter(F.getbit(byte, F.col("_bit").bitwiseAND(F.lit(7)).cast("int")) == 1).select(*keys.columns)


def planned_bytes(frame: DataFrame) -> int:
    """Bytes of a table as the planner estimates them from its files."""
    return int(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def all_key_counts(frame: DataFrame, two_passes: bool | None = None) -> DataFrame:
    """(kind, key, count) of keys seen twice or more.

    In two passes the marks that recur are found first, and only texts of those are shuffled, at the price of a second scan. By default that
    is done for tables of ``TWO_PASS_BYTES`` or more. Counts are the same.
    """
    keys = _kind_keys(frame)
    if not (planned_bytes(frame) >= TWO_PASS_BYTES if two_passes is None else two_passes):
        return keys.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") >= MIN_COUNT)
    marks = checkpoint_table(repeated_marks(keys), "repeated-marks")
    kept = seen_again(keys, marks, marks.count())
    return kept.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") >= MIN_COUNT)


def fit_to(frame: DataFrame, path: str) -> FeatureState:
    """Fit and store, in passes over narrow columns that are each aggregated before their shuffle."""
    spark = frame.sparkSession
    all_key_counts(frame).write.mode("overwrite").partitionBy("kind").parquet(f"{path}/counts")
    source_table(frame).write.mode("overwrite").parquet(f"{path}/sources")
    record = primary_view()
    fields = F.array(*[F.struct(F.lit(name).alias("field"), record[name].alias("value")) for name in CATEGORIES])
    values = (
        frame.select(F.inline(fields)).groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    values.write.mode("overwrite").parquet(f"{path}/values")
    values = spark.read.parquet(f"{path}/values")
    for name in CATEGORIES:
        counts = values.filter(F.col("field") == name).select("value", "n")
        category_table(counts).write.mode("overwrite").parquet(f"{path}/{name}")
    facts = _facts(spark, path).collect()  # one row for each table and constant
    facts = [r if fits_broadcast((r.rows, r.key_bytes)) or r.kind not in COLUMNS else _bucketed(spark, path, r) for r in facts]
    spark.createDataFrame(facts, FACTS).coalesce(1).write.mode("overwrite").json(f"{path}/sizes")
    return load_state(spark, path)


FACTS = "kind string, rows long, key_bytes long, buckets int, web array<struct<name:string,value:double>>"


def _plain_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    if name in COUNT_KINDS:
        counts = spark.read.schema(f"{COLUMNS[name]}, kind string").parquet(f"{path}/counts")
        return counts.filter(F.col("kind") == name).select("key", "count")
    return spark.read.schema(COLUMNS[name]).parquet(f"{path}/{name}")


def _table_name(path: str) -> str:
    return f"netsieve_{hashlib.md5(path.encode()).hexdigest()}"


def _bucketed(spark: SparkSession, path: str, fact):
    """Stores a table once more by digest; the fact with its number of buckets."""
    table = _plain_table(spark, path, fact.kind)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-fact.rows // BUCKET_ROWS))
    rows = table.withColumn("digest", key_digest(F.col(table.columns[0])))
    place = qualified(spark, f"{path}/by-digest/{fact.kind}")
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(place)}")
    writer = rows.repartition(n, "digest").write.format("parquet").mode("overwrite").option("path", place)
    writer.bucketBy(n, "digest").sortBy("digest").saveAsTable(_table_name(place))
    return Row(kind=fact.kind, rows=fact.rows, key_bytes=fact.key_bytes, buckets=n, web=fact.web)


def _stored_table(spark: SparkSession, path: str, name: str, buckets: int) -> DataFrame:
    """A table as stored; bucketed ones are made known to the session's catalog, under a name that follows from the path."""
    if not buckets:
        return _plain_table(spark, path, name)
    place = qualified(spark, f"{path}/by-digest/{name}")
    known = _table_name(place)
    quoted = place.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {known} ({COLUMNS[name]}, digest binary) USING parquet "
        f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{quoted}'"
    )
    spark.catalog.refreshTable(known)
    return spark.table(known)


def _facts(spark: SparkSession, path: str) -> DataFrame:
    """(kind, rows, key_bytes, buckets, web) of each table, and the number of fitted rows as ``total``. ``web`` holds what ``WEB_LOOKUPS`` finds in the table; one scan for each stored table."""
    rows, none = F.count(F.lit(1)).alias("rows"), F.lit(0).cast("long")

    def found(name: str, hit, columns: dict[str, str]):
        return [F.struct(F.lit(n).alias("name"), F.max(F.when(hit, F.col(c))).cast("double").alias("value")) for n, c in columns.items()]

    def measured(table: DataFrame, key: str, web: list) -> list:
        size = F.coalesce(F.sum(F.octet_length(key)), none).cast("long").alias("key_bytes")
        empty = F.array().cast("array<struct<name:string,value:double>>")
        return [rows, size, F.lit(0).alias("buckets"), (F.array(*web) if web else empty).alias("web")]

    parts = []
    for name in ("sources", *CATEGORIES):
        table = _plain_table(spark, path, name)
        key = table.columns[0]
        wanted, columns = WEB_LOOKUPS[name]
        parts.append(table.agg(*measured(table, key, found(name, F.col(key) == wanted, columns))).withColumn("kind", F.lit(name)))
    counts = spark.read.schema("key string, count long, kind string").parquet(f"{path}/counts")
    web = [c for kind in ("dst", "src_dst") for c in found(kind, (F.col("kind") == kind) & (F.col("key") == WEB_LOOKUPS[kind][0]), WEB_LOOKUPS[kind][1])]
    parts.append(counts.groupBy("kind").agg(*measured(counts, "key", web)))
    whole = spark.read.parquet(f"{path}/values").filter(F.col("field") == "protocol").agg(F.coalesce(F.sum("n"), none).cast("long").alias("rows"))
    parts.append(whole.select(F.lit("total").alias("kind"), "rows", none.alias("key_bytes"), F.lit(0).alias("buckets"), F.array().cast("array<struct<name:string,value:double>>").alias("web")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("kind", "rows", "key_bytes", "buckets", "web")


def web_constants(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, value) of what ``WEB_LOOKUPS`` finds; at most one row for each value, as keys are unique."""
    parts = None
    for name, (key, columns) in WEB_LOOKUPS.items():
        table = tables[name]
        hit = table.filter(F.col(table.columns[0]) == key)
        pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).cast("double").alias("value")) for n, c in columns.items()])
        row = hit.select(F.inline(pairs))
        parts = row if parts is None else parts.unionByName(row)
    return parts


def load_state(spark: SparkSession, path: str) -> FeatureState:
    facts = {r.kind: r for r in spark.read.schema(FACTS).json(f"{path}/sizes").collect()}
    sizes = {name: (facts[name].rows, facts[name].key_bytes) if name in facts else (0, 0) for name in COLUMNS}
    tables = {name: _stored_table(spark, path, name, facts[name].buckets if name in facts else 0) for name in COLUMNS}
    return FeatureState(
        protocol=tables["protocol"],
        http_method=tables["http_method"],
        sources=tables["sources"],
        counts={kind: tables[kind] for kind in COUNT_KINDS},
        total=facts["total"].rows,
        sizes=sizes,
        constants={w.name: w.value for r in facts.values() for w in r.web or [] if w.value is not None},
    )


def publish_state(frame: DataFrame, root: str) -> str:
    """Fit a new version of the state below a root and point to it; its path. Versions that streams still use stay where they are."""
    path = f"{root}/versions/{uuid.uuid4().hex}"
    fit_to(frame, path)
    point_to(frame.sparkSession, root, path)
    return path


def point_to(spark: SparkSession, root: str, path: str) -> None:
    """Make a stored state the newest of a root: the next numbered pointer, which appears whole or not at all."""
    while True:
        number = int((file_names(spark, f"{root}/pointers") or ["0"])[-1]) + 1
        if claim_file(spark, f"{root}/pointers/{number:012d}", path):
            return


class PublishedState:
    """The newest state below a root. ``current`` looks at the pointers each time and loads a version once."""

    def __init__(self, root: str):
        self.root = root
        self.known: tuple[str, FeatureState] | None = None

    def current(self, spark: SparkSession) -> FeatureState:
        names = file_names(spark, f"{self.root}/pointers")
        if not names:
            raise FileNotFoundError(f"no state is published below {self.root}")
        if self.known is None or self.known[0] != names[-1]:
            path = spark.read.text(f"{self.root}/pointers/{names[-1]}").first().value
            self.known = (names[-1], load_state(spark, path))
        return self.known[1]


def state_summary(state: FeatureState) -> DataFrame:
    """(section, name, value): encoders, frequencies, size of each count map, feature list."""

    def section(name: str, frame: DataFrame, key: str, value: str) -> DataFrame:
        return frame.select(
            F.lit(name).alias("section"), F.col(key).alias("name"), F.col(value).cast("double").alias("value")
        )

    def size(kind: str, frame: DataFrame) -> DataFrame:
        return section("count_map_sizes", frame.agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind)), "kind", "n")

    names = list(enumerate(fixed.FEATURE_NAMES, start=1))
    features = state.sources.sparkSession.createDataFrame(names, "position int, name string")
    parts = [
        section("protocol_encoder", state.protocol.filter("code IS NOT NULL"), "value", "code"),
        section("http_method_encoder", state.http_method.filter("code IS NOT NULL"), "value", "code"),
        section("protocol_frequency", state.protocol, "value", "frequency"),
        section("http_method_frequency", state.http_method, "value", "frequency"),
        size("src", state.sources.filter(F.col("count") >= MIN_COUNT)),
        *[size(kind, table) for kind, table in state.counts.items()],
        section("feature_list", features, "name", "position"),
    ]
    summary = parts[0]
    for part in parts[1:]:
        summary = summary.unionByName(part)
    return summary
