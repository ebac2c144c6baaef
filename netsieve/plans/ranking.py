"""Sources ranked by the attack score of their requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import traffic_keys
from ..operators.features import score_features, text_features
from ..operators.lookups import lookup_key
from ..operators.records import primary_view, with_text
from ..operators.sizing import checkpoint_table
from ..operators.state import count_table, keyed


def attack_ranking(unified: DataFrame) -> DataFrame:
    """Per source: requests, total scores, and how often its requests repeat."""
    record = primary_view()
    # Stored, so that its size is known and hot requests are looked up apart.
    requests = checkpoint_table(count_table(keyed(unified), "request"), "request-counts")
    size = requests.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("key")), F.lit(0))).first()
    rows = with_text(unified)
    rows = lookup_key(rows, traffic_keys(record)["request"], requests, {"_request": "count"}, tuple(size), unified.count())
    counted = {f"_f_{name}": column for name, column in text_features(record["text"]).items()}
    rows = rows.withColumns(counted)
    scores = score_features({name[3:]: F.col(name) for name in counted})
    return (
        rows.select(
            traffic_keys(record)["src"].alias("src_key"),
            *[column.alias(name) for name, column in scores.items()],
            F.coalesce("_request", F.lit(0)).alias("repeats"),
        )
        .groupBy("src_key")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.sum("sql_attack_score").alias("sql_attack_score"),
            F.sum("xss_attack_score").alias("xss_attack_score"),
            F.max("repeats").alias("most_repeated"),
        )
        .orderBy(F.desc(F.col("sql_attack_score") + F.col("xss_attack_score")), "src_key")
    )
