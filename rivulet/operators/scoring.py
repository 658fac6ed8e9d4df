"""Scorers over parameter tables or literal coefficients.

A linear model is ``{"features": [...], "coef": [...], "intercept": b}``;
scoring is a projection of column expressions with the coefficients as
literals, so it runs in one stage, inside whole-stage codegen, with no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import OUT_PROBABILITY_OF_DEFAULT, OUT_PREDICTED_ADMIT
from ..functions.exprs import linear, sigmoid
from . import contract as C


def logistic_probability(model: Mapping) -> Column:
    return sigmoid(linear(model["features"], model["coef"], model["intercept"]))


def soft_vote(members: Sequence[Column]) -> Column:
    """Mean of member probabilities."""
    total = members[0]
    for m in members[1:]:
        total = total + m
    return total / F.lit(float(len(members)))


def score_binary(df: DataFrame, members: Sequence[Mapping], out_col: str = OUT_PROBABILITY_OF_DEFAULT,
                 scaler: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """Scaled features -> mean member probability (single model = one member)."""
    src = df
    if scaler:
        src = src.withColumns({f"_z_{f}": (F.col(f) - F.lit(float(m))) / F.lit(float(s))
                               for f, (m, s) in scaler.items()})
        members = [{**mm, "features": [f"_z_{f}" if f in scaler else f for f in mm["features"]]}
                   for mm in members]
    out = src.withColumn(out_col, soft_vote([logistic_probability(m) for m in members]))
    if scaler:
        out = out.drop(*[f"_z_{f}" for f in scaler])
    return out


def ovr_probabilities(df: DataFrame, classes: Sequence, models: Mapping, prob_prefix: str = "p_",
                      pred_col: str = "predicted", conf_col: str = "confidence") -> DataFrame:
    """One-vs-rest: sigmoid per class, normalised to sum 1 (all zero -> uniform).

    ``predicted`` is the first class with the highest probability and
    ``confidence`` that probability.
    """
    k = len(classes)
    raw = {c: logistic_probability(models[c]) for c in classes}
    out = df.withColumns({f"_s_{i}": raw[c] for i, c in enumerate(classes)})
    total = None
    for i in range(k):
        total = F.col(f"_s_{i}") if total is None else total + F.col(f"_s_{i}")
    out = out.withColumn("_tot", total)
    probs = {f"{prob_prefix}{c}": F.when(F.col("_tot") == 0, F.lit(1.0 / k))
             .otherwise(F.col(f"_s_{i}") / F.col("_tot")) for i, c in enumerate(classes)}
    out = out.withColumns(probs).drop("_tot", *[f"_s_{i}" for i in range(k)])
    arr = F.array(*[F.col(f"{prob_prefix}{c}") for c in classes])
    best = F.array_max(arr)
    labels = F.array(*[F.lit(c) for c in classes])
    return out.withColumn(pred_col, F.element_at(labels, F.array_position(arr, best).cast("int"))) \
              .withColumn(conf_col, best)


def score_regression(df: DataFrame, model: Mapping, out_col: str = OUT_PREDICTED_ADMIT) -> DataFrame:
    """Linear prediction, unclipped."""
    return df.withColumn(out_col, linear(model["features"], model["coef"], model["intercept"]))


def input_rules(features: Sequence[str]) -> dict[str, Column]:
    """Failure predicates for scoring input: a feature that is null or NaN."""
    rules = {}
    for f in features:
        c = F.col(f)
        rules[f"null:{f}"] = c.isNull() | F.isnan(c.cast("double"))
    return rules


def score_with_quarantine(df: DataFrame, features: Sequence[str], scorer, out_cols: Sequence[str],
                          output_contract: Mapping | None = None) -> DataFrame:
    """Route unscorable rows to quarantine instead of losing them.

    Input rules run first; the scorer runs on every row (a projection) and the
    output contract (required + castable + non-null outputs) is then checked,
    so both input and output violations carry a reason.
    """
    routed = C.with_reasons(df, input_rules(features))
    scored = scorer(routed)
    out_rules = {}
    for c in out_cols:
        out_rules[f"output_null:{c}"] = F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    if output_contract:
        C.require_columns(scored, output_contract)
        for c, t in output_contract.get("dtypes", {}).items():
            if c in scored.columns:
                out_rules[f"output_cast:{c}"] = C.cast_failed(F.col(c), F.col(c).try_cast(C.spark_type(t)))
    extra = [F.when(F.coalesce(cond, F.lit(False)), F.lit(n)) for n, cond in out_rules.items()]
    reasons = F.concat(F.col(C.REASONS_COL), F.filter(F.array(*extra), lambda x: x.isNotNull()))
    scored = scored.withColumn(C.REASONS_COL, reasons)
    route = F.when(F.size(C.REASONS_COL) == 0, F.lit(C.VALID)).otherwise(F.lit(C.QUARANTINED))
    return scored.withColumn(C.ROUTE_COL, route).withColumns(
        {c: F.when(F.col(C.ROUTE_COL) == C.VALID, F.col(c)) for c in out_cols})
