"""Mixing sources to target weights: hash-random order in each source, prefix sums of sizes, an exact cut, repeated epochs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from netsieve.llm.rows import fresh
from netsieve.llm.words import bounded_broadcast, word_count
from netsieve.operators.sizing import checkpoint_table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
KEY_BITS = 60
BUCKET_BITS = 12
MAX_BROADCAST_SOURCES = 10_000
STEP = 1_000  # rows that one generated array names


def order_key(key: Column) -> Column:
    """A number of 60 bits that looks random and depends on the key alone."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, weights: Sequence[float], share: float, max_epochs: float) -> DataFrame:
    """source, source_size -> and target. ``share`` of all sizes is dealt by weight; no target exceeds ``max_epochs`` times
    its source's size, and what is over goes to the others by weight.

    Dealing again until nothing is over ends at ``target = min(cap, level x weight)`` with one level for all. With
    sources in order of cap / weight, the level is the first at which the next source is not filled. One row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    table = F.array(*[F.lit(float(w)) for w in weights])
    rows = (
        sources.withColumn("place", F.row_number().over(order) - 1)
        .withColumn("weight", F.element_at(table, (F.col("place") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
        .withColumn("filled_at", F.col("cap") / F.col("weight"))
    )
    lower = Window.orderBy("filled_at", "place").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("filled_at", "place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (
        rows.withColumn("caps_below", F.coalesce(F.sum("cap").over(lower), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(lower), F.lit(0.0)))
        .withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(whole))
        .withColumn("level", (F.col("budget") - F.col("caps_below")) / F.col("weight_left"))
        .withColumn("level", F.when(F.col("level") <= F.col("filled_at"), F.col("level")))
        .withColumn("level", F.max("level").over(whole))
    )
    return rows.select(
        "source",
        "source_size",
        F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"),
    )


def cut_plan(sized: DataFrame, weights: Sequence[float], share: float, max_epochs: float) -> DataFrame:
    """Sizes (source, bucket, size) -> for each source plan_source, source_size, target, epochs, the bucket of the cut and the words left for it."""
    cells = sized.groupBy("source", "bucket").agg(F.sum("size").alias("cell"))
    goals = targets(cells.groupBy("source").agg(F.sum("cell").alias("source_size")), weights, share, max_epochs)
    goals = (
        goals.withColumn("budget", F.round("target").cast("long"))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0)))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    )
    below = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    goals = goals.withColumnRenamed("source", "plan_source")
    summed = cells.withColumn("below", F.coalesce(F.sum("cell").over(below), F.lit(0)))
    cut = (
        summed.join(goals, F.col("source").eqNullSafe(F.col("plan_source")))
        .filter((F.col("below") <= F.col("rest")) & (F.col("rest") < F.col("below") + F.col("cell")))
        .select("plan_source", "source_size", "target", "epochs", F.col("bucket").alias("cut"), (F.col("rest") - F.col("below")).alias("left"))
    )
    empty = goals.filter("source_size = 0").select(
        "plan_source", "source_size", "target", "epochs", F.lit(-1).cast("long").alias("cut"), F.lit(0).cast("long").alias("left")
    )
    return cut.unionByName(empty)


def mix(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    bucket_bits: int = BUCKET_BITS,
) -> DataFrame:
    """Words that the mix takes of every document: doc_id, source, size, source_size, target, taken.

    Whole epochs take every document once. The rest of a budget is cut in hash order: sizes are summed by source and
    bucket (the leading ``bucket_bits`` of the key, at most sources x 2^bits rows), which finds the bucket of the cut; only
    the rows of that bucket are sorted, the others take their bucket's side. The row at the cut gives just the
    words that are missing, so that a source's sum is its target to the nearest word.

    The words are counted in one scan; the narrow result is written to the shared folder and read from there.
    Cases: null text: size 0; null source: a source, last in order; repeated rows are counted first and taken one after
    another; a source of size 0 takes nothing; empty table: no rows. Every run gives the same rows.
    """
    body, group = F.col(f"`{text}`"), F.col(f"`{source}`")
    sized = documents.select(
        F.col(f"`{key}`").alias("doc_id"),
        group.alias("source"),
        word_count(body).alias("size"),
        order_key(F.col(f"`{key}`")).alias("key"),
    ).withColumn("bucket", F.shiftright("key", KEY_BITS - bucket_bits))
    sized = checkpoint_table(sized, "mix-sizes")
    plan = checkpoint_table(cut_plan(sized, weights, share, max_epochs), "mix-plan")
    rows = sized.join(bounded_broadcast(plan, MAX_BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("plan_source")))
    aside = rows.filter(F.col("bucket") != F.col("cut")).withColumn(
        "taken", F.col("size") * (F.col("epochs") + (F.col("bucket") < F.col("cut")).cast("long"))
    )
    equal = ("doc_id", "source", "size", "key", "source_size", "target", "epochs", "left")
    atcut = rows.filter(F.col("bucket") == F.col("cut")).groupBy(*equal).agg(F.count(F.lit(1)).alias("copies"))
    ordered = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    atcut = (
        atcut.withColumn("before", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(ordered), F.lit(0)))
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("taken", F.greatest(F.lit(0).cast("long"), F.least("size", F.col("left") - F.col("before") - F.col("copy") * F.col("size"))))
        .withColumn("taken", F.col("taken") + F.col("size") * F.col("epochs"))
    )
    columns = ("doc_id", "source", "size", "source_size", "target", "taken")
    return aside.select(*columns).unionByName(atcut.select(*columns))


def mixed_documents(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    bucket_bits: int = BUCKET_BITS,
) -> DataFrame:
    """The documents as the mix takes them, with their own columns: a document taken twice is two rows, one taken
    in part has its first words joined by one blank, one not taken is left out.

    What is taken of a row follows from its source, its place in hash order (key, size and a hash of the whole row break ties) and the row at which the source's
    budget ends, of which there is one for each source. So takes are a projection over the documents beside a broadcast table of the sources, and
    no text is shuffled. Rows that equal the last one in every column are the same row: they are counted, and written again from one of them.
    Cases: empty documents and documents without words carry nothing and are left out; null keys and repeated keys are rows like others; a null
    source is a source; empty table: no rows; columns keep their names, whatever they are.
    """
    p = fresh(documents.columns, "_mix")
    names = ("key", "id", "size", "row")
    order = order_key(F.col(f"`{key}`"))
    whole = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) if isinstance(f.dataType, (MapType, VariantType)) else F.col(f"`{c}`") for c, f in zip(documents.columns, documents.schema.fields, strict=True)])
    placed = documents.withColumns(
        {
            f"{p}source": F.col(f"`{source}`"), f"{p}key": order, f"{p}id": F.col(f"`{key}`"), f"{p}size": word_count(F.col(f"`{text}`")),
            f"{p}row": whole, f"{p}bucket": F.shiftright(order, KEY_BITS - bucket_bits),
        }
    )
    sized = checkpoint_table(placed.select(*[F.col(p + n).alias(n) for n in ("source", *names, "bucket")]), "mix-sizes")
    plan = checkpoint_table(cut_plan(sized, weights, share, max_epochs), "mix-plan")
    atcut = sized.join(bounded_broadcast(plan, MAX_BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("plan_source")) & (F.col("bucket") == F.col("cut")))
    # rows of one bucket of each source, equal ones counted first
    atcut = atcut.filter("size > 0").groupBy("plan_source", "left", *names).agg(F.count(F.lit(1)).alias("copies"))
    upto = Window.partitionBy("plan_source").orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    atcut = atcut.withColumn("before", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(upto), F.lit(0)))
    last = atcut.filter((F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("size") * F.col("copies")))
    last = last.select(F.col("plan_source").alias("last_source"), F.struct(*names).alias("last"), "copies", (F.col("left") - F.col("before")).alias("words"))
    goal = plan.join(last, F.col("plan_source").eqNullSafe(F.col("last_source")), "left")
    goal = checkpoint_table(goal.select(*[F.col(c).alias(p + "_" + c) for c in ("plan_source", "epochs", "cut", "last", "copies", "words")]), "mix-goal")
    goal = bounded_broadcast(goal, MAX_BROADCAST_SOURCES)
    rows = placed.join(goal, F.col(f"{p}source").eqNullSafe(F.col(f"{p}_plan_source"))).filter(F.col(f"{p}size") > 0)
    here = F.struct(*[F.col(p + n).alias(n) for n in names])
    incut = F.col(f"{p}bucket") == F.col(f"{p}_cut")
    ends = incut & F.coalesce(here == F.col(f"{p}_last"), F.lit(False))
    early = (F.col(f"{p}bucket") < F.col(f"{p}_cut")) | (incut & F.coalesce(here < F.col(f"{p}_last"), F.lit(False)))
    times = F.col(f"{p}_epochs") + early.cast("long")
    out = [F.col(f"`{c}`") for c in documents.columns]
    taken = rows.filter(~ends & (times > 0)).withColumn(f"{p}copy", F.explode(F.sequence(F.lit(1).cast("long"), times))).select(*out)

    final = rows.filter(ends).groupBy(f"{p}source", f"{p}size", f"{p}_epochs", f"{p}_copies", f"{p}_words").agg(F.first(F.struct(*out)).alias("row"))
    size, words = F.col(f"{p}size"), F.col(f"{p}_words")
    again = F.col(f"{p}_copies") * F.col(f"{p}_epochs") + F.floor(words / size).cast("long")
    rest = (words % size).cast("int")
    thousands = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((again - 1) / STEP).cast("long")))
    copies = final.filter(again > 0).withColumn("again", again).withColumn("block", thousands)
    copies = copies.withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(STEP).cast("long"), F.col("again") - F.col("block") * STEP)))).select("row.*")
    part = final.filter(rest > 0).select("row.*", rest.alias(f"{p}rest"))
    body = F.array_join(F.slice(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"([^\x20\x09-\x0D]+)")), 1, F.col(f"{p}rest")), " ")
    renewed = {text: body} | ({"n_chars": F.length(body).cast(documents.schema["n_chars"].dataType)} if "n_chars" in documents.columns else {})
    part = part.withColumns(renewed).select(*out)
    return taken.unionByName(copies).unionByName(part)
