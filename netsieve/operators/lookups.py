"""Lookups of fitted state beside each record.

Tables are met by the 16-byte digest of the key, so long keys cost no more than short ones. Stored
state carries its size, and the size picks the join:

* a table below ``BROADCAST_ROWS`` and ``BROADCAST_BYTES`` is broadcast, no record is shuffled;
* a larger one is stored in buckets by digest and stays where it is; records are dealt to its buckets,
  after its hot keys are split off. A hot key holds at least 1 / ``HOT_KEYS`` of the fitted rows, so there
  are at most ``HOT_KEYS`` of them: that part is broadcast. A record with a hot key is then spread over the
  shuffle by the index of its input partition, which a retried task reproduces, so no task receives
  a whole hot key. Adaptive skew splitting covers keys that are hot only in the scored data.

A micro-batch asks large tables for its own keys first (:func:`narrowed`), so it reads their buckets only.
Lazy state has no recorded size; the planner decides from run-time statistics.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import key_digest, traffic_keys
from ..functions.reuse import built_once
from .records import VIEWS, WEB_TEXT, code_cut, with_text, with_web_text
from .state import CATEGORIES, COUNT_KINDS, MIN_COUNT, WEB_LOOKUPS, FeatureState, fits_broadcast, web_constants

HOT_KEYS = 10_000
WANTED_KEYS = 4_096  # keys of a kind for which a micro-batch asks by name


def _join(frame: DataFrame, digest: Column, table: DataFrame, values: dict[str, str], hint: bool) -> DataFrame:
    own = F.col("digest") if "digest" in table.columns else key_digest(F.col(table.columns[0]))
    right = table.select(own.alias("_found"), *[F.col(c).alias(n) for n, c in values.items()])
    if hint:
        right = F.broadcast(right)
    return frame.withColumn("_key", digest).join(right, F.col("_key") == F.col("_found"), "left").drop("_key", "_found")


def _lookup(
    frame: DataFrame,
    key: Column,
    table: DataFrame,
    values: dict[str, str],
    size: tuple[int, int] | None,
    hot: Column | None,
    wanted: Column | None = None,
) -> DataFrame:
    digest = key_digest(key)
    spread = F.encode(F.concat(F.lit("\x00"), F.spark_partition_id().cast("string")), "utf-8")  # shorter than any digest
    if wanted is not None:
        digest = F.when(wanted, digest).otherwise(spread)
    if size is None or hot is None:
        return _join(frame, digest, table, values, hint=False)
    if fits_broadcast(size):
        return _join(frame, digest, table, values, hint=True)
    hot_names = {f"_hot{name}": column for name, column in values.items()}
    hot_table = table.filter(hot).withColumn("_is_hot", F.lit(True))
    frame = frame.withColumn("_at", digest)
    frame = _join(frame, F.col("_at"), hot_table, hot_names | {"_is_hot": "_is_hot"}, hint=True)
    frame = frame.withColumn("_at", F.when(F.col("_is_hot"), spread).otherwise(F.col("_at")))
    frame = _join(frame, F.col("_at"), table.filter(~hot), values, hint=False)
    frame = frame.withColumns({name: F.coalesce(F.col(f"_hot{name}"), F.col(name)) for name in values})
    return frame.drop("_at", "_is_hot", *hot_names)


def lookup_key(
    frame: DataFrame,
    key: Column,
    table: DataFrame,
    values: dict[str, str],
    size: tuple[int, int] | None = None,
    total: int | None = None,
    wanted: Column | None = None,
) -> DataFrame:
    """Left lookup of ``values`` (new name -> table column) by key; null where the key is unknown.

    Rows that are not ``wanted`` keep null and are spread like hot keys.
    """
    hot = None if total is None else F.col("count") >= max(MIN_COUNT, -(-total // HOT_KEYS))
    return _lookup(frame, key, table, values, size, hot, wanted)


def lookup_category(
    frame: DataFrame, value: Column, table: DataFrame, values: dict[str, str], size: tuple[int, int] | None
) -> DataFrame:
    """The same for categories; their frequency says which are hot."""
    return _lookup(frame, value, table, values, size, F.col("frequency") >= 1 / HOT_KEYS)


@built_once
def _view_keys(view: str) -> dict[str, Column]:
    return traffic_keys(VIEWS[view]())


def with_lookups(frame: DataFrame, state: FeatureState, prefix: str = "_") -> DataFrame:
    """All category and key lookups of the record, as ``<prefix><name>`` columns."""
    record, keys = VIEWS["primary"](), _view_keys("primary")
    for name in CATEGORIES:
        table = getattr(state, name)
        values = {f"{prefix}{name}_code": "code", f"{prefix}{name}_frequency": "frequency"}
        frame = lookup_category(frame, record[name], table, values, state.sizes.get(name))
    frame = lookup_key(
        frame, keys["src"], state.sources, {f"{prefix}src": "count", f"{prefix}ports": "ports"},
        state.sizes.get("sources"), state.total,
    )
    for position, kind in enumerate(COUNT_KINDS):
        if position % 2 == 0:
            frame = code_cut(frame)
        frame = lookup_key(
            frame, keys[kind], state.counts[kind], {f"{prefix}{kind}": "count"}, state.sizes.get(kind), state.total
        )
    return code_cut(frame)


def with_web_lookups(frame: DataFrame, state: FeatureState, wanted: Column, prefix: str = "_web_") -> DataFrame:
    """Lookups of the web-payload view. Only the endpoint and request keys differ between rows; the
    other keys are the same for every payload: their few values are recorded with stored state and become literals."""
    constants = _web_constants(state)
    frame = frame.withColumns({f"{prefix}{name}": F.lit(value) for name, value in constants.items()})
    keys = _view_keys("web")
    for kind in ("endpoint", "request"):
        frame = lookup_key(
            frame, keys[kind], state.counts[kind], {f"{prefix}{kind}": "count"}, state.sizes.get(kind), state.total, wanted
        )
    return code_cut(frame, WEB_TEXT)


def _web_constants(state: FeatureState) -> dict[str, float]:
    found = state.constants
    if found is None:  # lazy state
        found = {r.name: r.value for r in web_constants({name: state.table(name) for name in WEB_LOOKUPS}).collect()}
    return {name: found.get(name) or 0.0 for _, columns in WEB_LOOKUPS.values() for name in columns}


def narrowed(state: FeatureState, batch: DataFrame, web: str | None = None) -> FeatureState:
    """The state as a micro-batch needs it: of tables too large to broadcast only the rows of the keys that occur in it.

    ``batch`` is a static table of unified records that is cheap to read twice. Keys reach the driver as digests, at most ``WANTED_KEYS`` of each kind; the filter names
    them, so buckets without any are not opened and the rest is read from sorted files. With more keys the whole
    table is joined in its buckets. ``web`` is the column with the URI of the second view, which has other endpoint and request keys.
    """
    record = VIEWS["primary"]()
    keys = _view_keys("primary")
    asked = {"sources": keys["src"], **{kind: keys[kind] for kind in COUNT_KINDS}, **{name: record[name] for name in CATEGORIES}}
    large = [name for name in asked if name in state.sizes and not fits_broadcast(state.sizes[name])]
    if not large:
        return state
    rows = with_text(batch)
    pairs = [F.struct(F.lit(name).alias("kind"), key_digest(asked[name]).alias("digest")) for name in large]
    rows = rows.select(F.inline(F.array(*pairs)))
    if web is not None:
        again = [kind for kind in ("endpoint", "request") if kind in large]
        if again:
            view = with_web_text(batch, web, F.lit(True))
            pairs = [F.struct(F.lit(k).alias("kind"), key_digest(_view_keys("web")[k]).alias("digest")) for k in again]
            rows = rows.unionByName(view.select(F.inline(F.array(*pairs))))
    wanted: dict[str, list] = {}
    for row in rows.distinct().limit(WANTED_KEYS * len(large) + 1).collect():
        wanted.setdefault(row.kind, []).append(row.digest)
    if sum(map(len, wanted.values())) > WANTED_KEYS * len(large):
        return state
    tables, sizes = {}, dict(state.sizes)
    for name in large:
        names = ", ".join(f"X'{bytes(d).hex()}'" for d in wanted.get(name, []) if d is not None)
        table = state.table(name)
        own = "digest" if "digest" in table.columns else f"unhex(md5(cast({table.columns[0]} as binary)))"
        tables[name] = table.filter(F.expr(f"{own} IN ({names})")) if names else table.filter("false")
        sizes[name] = (len(wanted.get(name, [])), 16 * len(wanted.get(name, [])))
    counts = {kind: tables.get(kind, table) for kind, table in state.counts.items()}
    return replace(state, counts=counts, sizes=sizes, **{n: t for n, t in tables.items() if n not in counts})
