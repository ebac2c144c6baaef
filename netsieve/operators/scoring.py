"""Probability scoring with an optional second view, view choice, decision and risk."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.patterns import is_suspicious
from ..functions.reuse import built_once
from ..functions.text import once
from .features import with_features
from .lookups import with_lookups, with_web_lookups
from .models import with_probability
from .records import with_text, with_web_text
from .state import FeatureState

# A scorer adds "<prefix>probability" to a table with "<prefix><feature>" columns.
Scorer = Callable[[DataFrame, str], DataFrame]

HAS_WEB_VIEW = "_has_web_view"


def model_scorer(model) -> Scorer:
    return lambda features, prefix: with_probability(features, model, prefix)


def rule_scorer(features: DataFrame, prefix: str = "") -> DataFrame:
    """A transparent baseline: the share score / (score + 4) of the attack scores and two flow hints."""
    score = (
        F.col(f"{prefix}sql_attack_score").cast("double")
        + F.col(f"{prefix}xss_attack_score").cast("double")
        + 0.5 * F.col(f"{prefix}dst_port_is_system").cast("double")
        + 0.25 * F.col(f"{prefix}uri_special_char_ratio").cast("double")
    )
    return features.withColumn(f"{prefix}probability", score / (score + 4.0))


@built_once
def _suspicious(uri: str) -> Column:
    return is_suspicious(F.col(uri))


def _score_rows(frame: DataFrame, state: FeatureState, scorer: Scorer, keep: list[str], web_uri: str | None) -> DataFrame:
    """``keep`` columns, ``probability`` and ``web_probability`` (null without a web view)."""
    kept = [f"_keep_{name}" for name in keep]
    frame = with_text(frame).withColumns(dict(zip(kept, [F.col(name) for name in keep])))
    frame = with_lookups(frame, state)
    if web_uri is None:
        table = scorer(with_features(frame, "primary", kept), "")
        web = F.lit(None).cast("double")
    else:
        frame = with_web_lookups(with_web_text(frame, web_uri, F.col(HAS_WEB_VIEW)), state, F.col(HAS_WEB_VIEW))
        carried = [*kept, HAS_WEB_VIEW, *[c for c in frame.columns if c.startswith("_web_")]]
        table = scorer(with_features(frame, "primary", carried), "").select(*carried, "probability")
        table = scorer(with_features(table, "web", [*kept, HAS_WEB_VIEW, "probability"], "_web_", "web_"), "web_")
        web = F.when(F.col(HAS_WEB_VIEW), F.col("web_probability"))
    return table.select(
        *[F.col(k).alias(n) for k, n in zip(kept, keep)],
        once(F.col("probability")).alias("probability"),
        once(web).alias("web_probability"),
    )


def choose_view(scored: DataFrame) -> DataFrame:
    """The higher of both probabilities; on a tie the primary view stays."""
    web_wins = F.coalesce(F.col("web_probability") > F.col("probability"), F.lit(False))
    return scored.select(
        *[c for c in scored.columns if c not in ("probability", "web_probability")],
        F.when(web_wins, F.col("web_probability")).otherwise(F.col("probability")).alias("malicious_probability"),
        F.when(web_wins, F.lit(fixed.WEB_VIEW)).otherwise(F.lit(fixed.PRIMARY_VIEW)).alias("selected_view"),
    )


def decide(probability: Column) -> Column:
    return (probability >= fixed.DECISION_THRESHOLD).cast("int")


def risk_level(probability: Column) -> Column:
    (high, first), *others = fixed.RISK_LEVELS
    level = F.when(probability >= high, F.lit(first))
    for bound, name in others:
        level = level.when(probability >= bound, F.lit(name))
    return level.otherwise(F.lit(fixed.LOWEST_RISK))


def score_both_views(
    frame: DataFrame,
    state: FeatureState,
    scorer: Scorer,
    keep: Sequence[str] = (),
    web_uri: str | None = "uri",
    branch: bool = False,
) -> DataFrame:
    """``keep`` columns plus ``probability`` and ``web_probability``.

    ``frame`` holds unified records. Rows whose ``web_uri`` column looks like an attack also get the
    web view, as a second set of feature columns on the same row; None gives no row one. The other
    rows have an empty web view, which costs little to build but is scored too. ``branch`` scores them
    in a branch of their own without it: worth a second scan when ``web_uri`` is a stored column and
    the model is large. Not for streams.
    """
    wanted = list(dict.fromkeys([*keep, *fixed.NETWORK_FIELDS]))
    if web_uri is None:
        return _score_rows(frame.select(*wanted), state, scorer, list(keep), None)
    wanted = list(dict.fromkeys([*wanted, web_uri]))
    flagged = frame.select(*wanted, _suspicious(web_uri).alias(HAS_WEB_VIEW))
    if not branch:
        return _score_rows(flagged, state, scorer, list(keep), web_uri)
    plain = _score_rows(flagged.filter(~F.col(HAS_WEB_VIEW)), state, scorer, list(keep), None)
    both = _score_rows(flagged.filter(F.col(HAS_WEB_VIEW)), state, scorer, list(keep), web_uri)
    return plain.unionByName(both)


def predict(
    frame: DataFrame,
    state: FeatureState,
    scorer: Scorer,
    keep: Sequence[str] = (),
    web_uri: str | None = "uri",
    branch: bool = False,
) -> DataFrame:
    """``keep`` columns plus malicious_probability, selected_view, prediction."""
    scored = choose_view(score_both_views(frame, state, scorer, keep, web_uri, branch))
    return scored.withColumn("prediction", decide(F.col("malicious_probability")))


def prediction_records(
    frame: DataFrame,
    state: FeatureState,
    scorer: Scorer,
    index: str = "index",
    web_uri: str | None = "uri",
    branch: bool = False,
) -> DataFrame:
    """index, prediction, malicious_probability, selected_view, normalized_record."""
    keep = [index, *fixed.NETWORK_FIELDS]
    scored = predict(frame, state, scorer, keep, web_uri, branch)
    return scored.select(
        F.col(index).alias("index"),
        "prediction",
        "malicious_probability",
        "selected_view",
        F.struct(*fixed.NETWORK_FIELDS).alias("normalized_record"),
    )
