"""Registered queries: moments, scaling, kernel, scorers and evaluation metrics.

Scores come from rule-generated literal models (``fixtures``), so every
metric is checked exactly against SQL without any training in the loop.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import r6, unit_hash_sql
from ..operators import features as FE
from ..operators import labels as L
from ..operators import metrics as M
from ..operators import scoring as S
from .fixtures import (BINARY_FEATURES, BINARY_LABEL_SQL, LINEITEM_KEY_SQL, MULTI_CLASSES, REGRESSION,
                       SEED, TEST_RATIO, binary_label, binary_members, linear_sql, lineitem_key, lit_sql,
                       load, ovr_models, r6_sql, sigmoid_sql)
from .registry import query

# ------------------------------------------------------------------ helpers


def soft_vote_sql(members, prefix="") -> str:
    parts = [sigmoid_sql(linear_sql(m, prefix)) for m in members]
    s = parts[0]
    for p in parts[1:]:
        s = f"({s} + {p})"
    return f"({s} / {lit_sql(len(members))})"


def scaled_members(n: int = 7) -> list[dict]:
    """Members over standard-scaled binary features (rule-generated)."""
    return [{"features": BINARY_FEATURES,
             "coef": [0.3 + 0.05 * i, -0.2 + 0.02 * i, 0.4 - 0.1 * i, -0.1 + 0.05 * i],
             "intercept": -0.8 + 0.1 * i} for i in range(n)]


TRAIN_WHERE_SQL = f"NOT ({unit_hash_sql(LINEITEM_KEY_SQL, SEED)} < CAST({TEST_RATIO} AS DOUBLE))"


def moments_sql(where: str | None = TRAIN_WHERE_SQL) -> str:
    w = f"WHERE {where}" if where else ""
    sel = []
    for f in BINARY_FEATURES:
        sel.append(f"avg({f}) AS {f}_mean, "
                   f"CASE WHEN stddev_pop({f}) = 0 THEN 1.0 ELSE stddev_pop({f}) END AS {f}_scale")
    return f"(SELECT {', '.join(sel)} FROM lineitem {w})"


def scaled_select_sql() -> str:
    return ", ".join(f"(l.{f} - m.{f}_mean) / m.{f}_scale AS {f}" for f in BINARY_FEATURES)


def train_rows(spark, d):
    li = load(spark, d, "lineitem")
    return li.where(~L.holdout_flag(lineitem_key(), TEST_RATIO, SEED))


def ovr_sql_select(prefix: str = "") -> tuple[str, str]:
    """(probability columns SQL, CTE body) for the OvR literal models."""
    models = ovr_models()
    s_cols = ", ".join(f"{sigmoid_sql(linear_sql(models[c], prefix))} AS s_{c}" for c in MULTI_CLASSES)
    tot = " + ".join(f"s_{c}" for c in MULTI_CLASSES)
    k = len(MULTI_CLASSES)
    p_cols = ", ".join(f"CASE WHEN ({tot}) = 0 THEN {lit_sql(1.0 / k)} ELSE s_{c} / ({tot}) END AS p_{c}"
                       for c in MULTI_CLASSES)
    return s_cols, p_cols


OVR_PRED_SQL = ("CASE WHEN p_A >= p_N AND p_A >= p_R THEN 'A' WHEN p_N >= p_R THEN 'N' ELSE 'R' END")
OVR_CONF_SQL = "greatest(p_A, p_N, p_R)"


def ovr_base_sql() -> str:
    s_cols, p_cols = ovr_sql_select()
    return f"""
WITH s AS (SELECT l_orderkey, l_linenumber, l_returnflag, {s_cols} FROM lineitem),
     p AS (SELECT l_orderkey, l_linenumber, l_returnflag, {p_cols} FROM s)"""


def ovr_scored(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", *BINARY_FEATURES)
    return S.ovr_probabilities(li, MULTI_CLASSES, ovr_models())


def soft_vote_frame(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", binary_label().alias("label"),
                                           *BINARY_FEATURES)
    return S.score_binary(li, binary_members(), out_col="probability")


SOFT_VOTE_CTE = f"""
WITH sv AS (SELECT l_orderkey, l_linenumber, {BINARY_LABEL_SQL} AS label,
                   {soft_vote_sql(binary_members())} AS probability FROM lineitem)"""

# ------------------------------------------------------------------ features


@query("feature_moments", "G4", "SELECT feature, " + r6_sql("mean") + " AS mean, " + r6_sql("scale")
       + " AS scale FROM (" + " UNION ALL ".join(
           f"SELECT '{f}' AS feature, avg({f}) AS mean, "
           f"CASE WHEN stddev_pop({f}) = 0 THEN 1.0 ELSE stddev_pop({f}) END AS scale "
           f"FROM lineitem WHERE {TRAIN_WHERE_SQL}" for f in BINARY_FEATURES) + ")")
def q_feature_moments(spark, d):
    mom = FE.feature_moments(train_rows(spark, d), BINARY_FEATURES)
    return mom.select("feature", r6("mean").alias("mean"), r6("scale").alias("scale"))


@query("standard_scale", "M1", f"""
SELECT l.l_orderkey, l.l_linenumber, {', '.join(
    f"{r6_sql(f'(l.{f} - m.{f}_mean) / m.{f}_scale')} AS z_{f}" for f in BINARY_FEATURES)}
FROM lineitem l, {moments_sql()} m
""")
def q_standard_scale(spark, d):
    mom = FE.collect_moments(FE.feature_moments(train_rows(spark, d), BINARY_FEATURES))
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *BINARY_FEATURES)
    out = FE.standard_scale(li, mom, suffix="_z")
    return out.select("l_orderkey", "l_linenumber",
                      *[r6(f"{f}_z").alias(f"z_{f}") for f in BINARY_FEATURES])


NYSTROEM_GAMMA, NYSTROEM_C = 0.1, 8


def _nystroem_sql() -> str:
    x = ("SELECT p_partkey, CAST(p_size AS DOUBLE) / CAST(50 AS DOUBLE) AS x1, "
         "p_retailprice / CAST(2000 AS DOUBLE) AS x2 FROM part")
    basis = (f"SELECT x1, x2, row_number() OVER (ORDER BY md5('{SEED}|' || CAST(p_partkey AS VARCHAR)), "
             f"p_partkey) - 1 AS j FROM x")
    piv = ", ".join(f"max(CASE WHEN j = {j} THEN x1 END) AS b{j}x1, max(CASE WHEN j = {j} THEN x2 END) AS b{j}x2"
                    for j in range(NYSTROEM_C))
    ks = ", ".join(
        f"{r6_sql(f'exp({lit_sql(-NYSTROEM_GAMMA)} * ((x.x1 - b.b{j}x1) * (x.x1 - b.b{j}x1) + (x.x2 - b.b{j}x2) * (x.x2 - b.b{j}x2)))')} AS k{j}"
        for j in range(NYSTROEM_C))
    return f"""
WITH x AS ({x}), bs AS ({basis}), b AS (SELECT {piv} FROM bs WHERE j < {NYSTROEM_C})
SELECT x.p_partkey, {ks} FROM x, b
"""


@query("nystroem_kernel", "M2", _nystroem_sql())
def q_nystroem_kernel(spark, d):
    p = load(spark, d, "part").select(
        "p_partkey", (F.col("p_size").cast("double") / F.lit(50.0)).alias("x1"),
        (F.col("p_retailprice") / F.lit(2000.0)).alias("x2"))
    basis = FE.select_basis(p, "p_partkey", ["x1", "x2"], NYSTROEM_C, SEED)
    out = FE.kernel_columns(p, ["x1", "x2"], basis, NYSTROEM_GAMMA)
    return out.select("p_partkey", *[r6(f"k{j}").alias(f"k{j}") for j in range(len(basis))])


# ------------------------------------------------------------------ scorers


@query("soft_vote", "G15", SOFT_VOTE_CTE + f"""
SELECT l_orderkey, l_linenumber, {r6_sql('probability')} AS probability FROM sv
""")
def q_soft_vote(spark, d):
    return soft_vote_frame(spark, d).select("l_orderkey", "l_linenumber", r6("probability").alias("probability"))


@query("decide_probability", "P13", SOFT_VOTE_CTE + """
SELECT l_orderkey, l_linenumber, CAST(probability >= 0.5 AS INTEGER) AS decision FROM sv
""")
def q_decide_probability(spark, d):
    sv = soft_vote_frame(spark, d)
    return sv.select("l_orderkey", "l_linenumber", L.decide("probability").alias("decision"))


@query("score_binary", "M11", f"""
WITH z AS (SELECT l.l_orderkey, l.l_linenumber, {scaled_select_sql()} FROM lineitem l, {moments_sql()} m)
SELECT l_orderkey, l_linenumber, {r6_sql(soft_vote_sql(scaled_members()))} AS probability_of_default,
       CAST({soft_vote_sql(scaled_members())} >= 0.5 AS INTEGER) AS predicted_default
FROM z
""")
def q_score_binary(spark, d):
    mom = FE.collect_moments(FE.feature_moments(train_rows(spark, d), BINARY_FEATURES))
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *BINARY_FEATURES)
    out = S.score_binary(li, scaled_members(), out_col="probability_of_default", scaler=mom)
    return out.select("l_orderkey", "l_linenumber", r6("probability_of_default").alias("probability_of_default"),
                      L.decide("probability_of_default").alias("predicted_default"))


@query("ovr_probability", "M7", ovr_base_sql() + f"""
SELECT l_orderkey, l_linenumber, {r6_sql('p_A')} AS p_A, {r6_sql('p_N')} AS p_N, {r6_sql('p_R')} AS p_R,
       {OVR_PRED_SQL} AS predicted, {r6_sql(OVR_CONF_SQL)} AS confidence FROM p
""")
def q_ovr_probability(spark, d):
    out = ovr_scored(spark, d)
    return out.select("l_orderkey", "l_linenumber", *[r6(f"p_{c}").alias(f"p_{c}") for c in MULTI_CLASSES],
                      "predicted", r6("confidence").alias("confidence"))


@query("score_multiclass", "M14", ovr_base_sql() + f"""
SELECT l_orderkey, l_linenumber, {OVR_PRED_SQL} AS predicted_status,
       {r6_sql(OVR_CONF_SQL)} AS prediction_confidence FROM p
""")
def q_score_multiclass(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *BINARY_FEATURES)
    out = S.ovr_probabilities(li, MULTI_CLASSES, ovr_models(), pred_col="predicted_status",
                              conf_col="prediction_confidence")
    return out.select("l_orderkey", "l_linenumber", "predicted_status",
                      r6("prediction_confidence").alias("prediction_confidence"))


@query("score_regression", "M13", f"""
SELECT p_partkey, {r6_sql(linear_sql(REGRESSION))} AS predicted_price FROM part
""")
def q_score_regression(spark, d):
    out = S.score_regression(load(spark, d, "part"), REGRESSION, "predicted_price")
    return out.select("p_partkey", r6("predicted_price").alias("predicted_price"))


def _score_quarantine_sql() -> str:
    feats = ", ".join(f if f != "l_discount" else "nullif(l_discount, 0.0) AS l_discount" for f in BINARY_FEATURES)
    prob = soft_vote_sql(binary_members())
    reasons = ", ".join([f"CASE WHEN {f} IS NULL OR isnan({f}) THEN 'null:{f}' END" for f in BINARY_FEATURES]
                        + ["CASE WHEN pr IS NULL OR isnan(pr) THEN 'output_null:probability_of_default' END"])
    return f"""
WITH q AS (SELECT l_orderkey, l_linenumber, {feats} FROM lineitem),
     s AS (SELECT *, {prob} AS pr FROM q),
     r AS (SELECT l_orderkey, l_linenumber, pr, concat_ws(';', {reasons}) AS reason FROM s)
SELECT l_orderkey, l_linenumber, CASE WHEN reason = '' THEN 'valid' ELSE 'quarantine' END AS route, reason,
       CASE WHEN reason = '' THEN {r6_sql('pr')} END AS probability_of_default
FROM r
"""


@query("score_quarantine", "M15,P9", _score_quarantine_sql())
def q_score_quarantine(spark, d):
    from ..operators import contract as C
    li = load(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"), "l_tax")
    out = S.score_with_quarantine(
        li, BINARY_FEATURES, lambda df: S.score_binary(df, binary_members(), out_col="probability_of_default"),
        ["probability_of_default"])
    return out.select("l_orderkey", "l_linenumber", F.col(C.ROUTE_COL).alias("route"),
                      F.array_join(C.REASONS_COL, ";").alias("reason"),
                      r6("probability_of_default").alias("probability_of_default"))


OUTPUT_CONTRACT = {"required_columns": ["p_partkey", "predicted_price"], "dtypes": {"predicted_price": "float64"}}


@query("output_contract", "P19", f"""
WITH q AS (SELECT p_partkey, nullif(p_size, 1) AS p_size FROM part),
     s AS (SELECT p_partkey, p_size, {linear_sql(REGRESSION)} AS pr FROM q),
     r AS (SELECT p_partkey, pr, concat_ws(';', CASE WHEN p_size IS NULL OR isnan(p_size) THEN 'null:p_size' END,
                                           CASE WHEN pr IS NULL OR isnan(pr) THEN 'output_null:predicted_price' END)
                    AS reason FROM s)
SELECT p_partkey, CASE WHEN reason = '' THEN 'valid' ELSE 'quarantine' END AS route,
       CASE WHEN reason = '' THEN {r6_sql('pr')} END AS predicted_price FROM r
""")
def q_output_contract(spark, d):
    from ..operators import contract as C
    p = load(spark, d, "part").select("p_partkey", F.nullif(F.col("p_size"), F.lit(1)).alias("p_size"))
    out = S.score_with_quarantine(p, ["p_size"], lambda df: S.score_regression(df, REGRESSION, "predicted_price"),
                                  ["predicted_price"], output_contract=OUTPUT_CONTRACT)
    return out.select("p_partkey", F.col(C.ROUTE_COL).alias("route"),
                      r6("predicted_price").alias("predicted_price"))


# ------------------------------------------------------------------ metrics


@query("confusion_matrix", "G6", ovr_base_sql() + f""",
     pr AS (SELECT l_returnflag AS true_label, {OVR_PRED_SQL} AS pred_label FROM p),
     cls AS (SELECT DISTINCT l_returnflag AS c FROM lineitem WHERE l_returnflag IS NOT NULL),
     cnt AS (SELECT true_label, pred_label, count(*) AS n FROM pr GROUP BY ALL)
SELECT a.c AS true_label, b.c AS pred_label, coalesce(cnt.n, 0) AS n
FROM cls a CROSS JOIN cls b LEFT JOIN cnt ON cnt.true_label = a.c AND cnt.pred_label = b.c
""")
def q_confusion_matrix(spark, d):
    scored = ovr_scored(spark, d)
    classes = L.collect_classes(scored, "l_returnflag")
    return M.confusion_matrix(scored, "l_returnflag", "predicted", classes)


def _weighted_sql(pairs_cte: str) -> str:
    return pairs_cte + f""",
     cnt AS (SELECT t, p, count(*) AS n FROM pairs GROUP BY ALL),
     sup AS (SELECT t AS c, sum(n) AS s FROM cnt GROUP BY t),
     prd AS (SELECT p AS c, sum(n) AS s FROM cnt GROUP BY p),
     tp AS (SELECT t AS c, sum(n) AS s FROM cnt WHERE t = p GROUP BY t),
     cls AS (SELECT c FROM sup UNION SELECT c FROM prd),
     st AS (SELECT cls.c, coalesce(sup.s, 0) AS support, coalesce(prd.s, 0) AS predicted, coalesce(tp.s, 0) AS tp
            FROM cls LEFT JOIN sup ON sup.c = cls.c LEFT JOIN prd ON prd.c = cls.c LEFT JOIN tp ON tp.c = cls.c),
     pr AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / predicted END AS pp,
                      CASE WHEN support = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / support END AS rr FROM st),
     f AS (SELECT *, CASE WHEN pp + rr = 0 THEN 0.0 ELSE 2.0 * pp * rr / (pp + rr) END AS ff FROM pr)
SELECT {r6_sql('CAST(sum(tp) AS DOUBLE) / sum(support)')} AS accuracy,
       {r6_sql('sum(pp * support) / sum(support)')} AS precision_weighted,
       {r6_sql('sum(rr * support) / sum(support)')} AS recall_weighted,
       {r6_sql('sum(ff * support) / sum(support)')} AS f1_weighted
FROM f
"""


def _round_all(df):
    return df.select(*[r6(c).alias(c) for c in df.columns])


@query("weighted_metrics_multiclass", "G7", _weighted_sql(
    ovr_base_sql() + f""",
     pairs AS (SELECT l_returnflag AS t, {OVR_PRED_SQL} AS p FROM p)"""))
def q_weighted_metrics_multiclass(spark, d):
    scored = ovr_scored(spark, d)
    classes = L.collect_classes(scored, "l_returnflag")
    return _round_all(M.weighted_metrics(M.confusion_matrix(scored, "l_returnflag", "predicted", classes)))


@query("weighted_metrics_binary", "G8", _weighted_sql(
    SOFT_VOTE_CTE + """,
     pairs AS (SELECT label AS t, CAST(probability >= 0.5 AS INTEGER) AS p FROM sv)"""))
def q_weighted_metrics_binary(spark, d):
    sv = soft_vote_frame(spark, d).withColumn("pred", L.decide("probability"))
    return _round_all(M.weighted_metrics_rows(sv, "label", "pred"))


@query("binary_metrics", "G9", f"""
WITH s AS (SELECT CAST(p_retailprice > 1500.0 AS INTEGER) AS t,
                  CAST({linear_sql(REGRESSION)} > 1500.0 AS INTEGER) AS p FROM part),
     c AS (SELECT count(*) FILTER (WHERE t = 1 AND p = 1) AS tp, count(*) FILTER (WHERE t <> 1 AND p = 1) AS fp,
                  count(*) FILTER (WHERE t = 1 AND p <> 1) AS fn, count(*) AS n,
                  count(*) FILTER (WHERE t = p) AS correct FROM s)
SELECT {r6_sql('CASE WHEN n = 0 THEN 0.0 ELSE CAST(correct AS DOUBLE) / n END')} AS accuracy,
       {r6_sql('CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END')} AS precision,
       {r6_sql('CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END')} AS recall,
       {r6_sql('CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END')} AS f1
FROM c
""")
def q_binary_metrics(spark, d):
    p = S.score_regression(load(spark, d, "part"), REGRESSION, "pred_price")
    p = p.select(L.binarise("p_retailprice", 1500.0).alias("t"), L.binarise("pred_price", 1500.0).alias("p"))
    return _round_all(M.binary_metrics(p, "t", "p"))


@query("roc_auc", "G10,W6", SOFT_VOTE_CTE + f""",
     g AS (SELECT probability AS s, count(*) FILTER (WHERE label = 1) AS pos,
                  count(*) FILTER (WHERE label <> 1) AS neg FROM sv GROUP BY probability),
     c AS (SELECT s, pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                  AS below FROM g)
SELECT {r6_sql('sum(pos * (below + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE))')} AS auc
FROM c
""")
def q_roc_auc(spark, d):
    sv = soft_vote_frame(spark, d)
    return _round_all(M.roc_auc(sv, "label", "probability"))


@query("regression_metrics", "G11", f"""
WITH s AS (SELECT p_retailprice AS y, {linear_sql(REGRESSION)} AS p FROM part),
     a AS (SELECT avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae, var_pop(y) AS v FROM s)
SELECT {r6_sql('CASE WHEN v = 0 THEN CASE WHEN mse = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 - mse / v END')} AS r2,
       {r6_sql('mse')} AS mse, {r6_sql('mae')} AS mae FROM a
""")
def q_regression_metrics(spark, d):
    p = S.score_regression(load(spark, d, "part"), REGRESSION, "pred_price")
    return _round_all(M.regression_metrics(p, "p_retailprice", "pred_price"))


@query("log_loss", "G12", ovr_base_sql() + f""",
     t AS (SELECT CASE l_returnflag WHEN 'A' THEN p_A WHEN 'N' THEN p_N ELSE p_R END AS pt FROM p)
SELECT {r6_sql(f"avg(-ln(least(greatest(pt, {lit_sql(M.EPS)}), {lit_sql(1.0 - M.EPS)})))")} AS log_loss FROM t
""")
def q_log_loss(spark, d):
    scored = ovr_scored(spark, d)
    pt = F.col("p_A")
    for c in MULTI_CLASSES[1:]:
        pt = F.when(F.col("l_returnflag") == c, F.col(f"p_{c}")).otherwise(pt)
    pt = F.when(F.col("l_returnflag") == "A", F.col("p_A")).otherwise(pt)
    return _round_all(M.log_loss(scored.withColumn("p_true", pt), "p_true"))


@query("metrics_long", "S12", _weighted_sql(
    SOFT_VOTE_CTE + """,
     pairs AS (SELECT label AS t, CAST(probability >= 0.5 AS INTEGER) AS p FROM sv)""").replace(
    "SELECT (round(CAST(sum(tp)", "SELECT * FROM (UNPIVOT (SELECT (round(CAST(sum(tp)", 1) + """)
ON accuracy, precision_weighted, recall_weighted, f1_weighted INTO NAME metric VALUE value)
""")
def q_metrics_long(spark, d):
    sv = soft_vote_frame(spark, d).withColumn("pred", L.decide("probability"))
    return M.metrics_long(_round_all(M.weighted_metrics_rows(sv, "label", "pred")))


# ------------------------------------------------------------ gradient steps


def _gradient_sql() -> str:
    m = binary_members()[0]
    z = linear_sql(m)
    grads = []
    for f, w in zip(m["features"], m["coef"], strict=True):
        grads.append(f"SELECT '{f}' AS feature, {r6_sql(f'avg(cw * (sg - y) * {f}) + {lit_sql(1e-4)} * {lit_sql(w)}')}"
                     f" AS grad FROM g")
    grads.append(f"SELECT '_intercept' AS feature, {r6_sql('avg(cw * (sg - y))')} AS grad FROM g")
    return f"""
WITH h AS (SELECT {BINARY_LABEL_SQL} AS y, count(*) AS n FROM lineitem GROUP BY 1),
     w AS (SELECT y, CAST(sum(n) OVER () AS DOUBLE) / ((count(*) OVER ()) * n) AS cw FROM h),
     g AS (SELECT l.*, {BINARY_LABEL_SQL} AS y, w.cw, {sigmoid_sql(z)} AS sg
           FROM lineitem l JOIN w ON {BINARY_LABEL_SQL.replace('l_returnflag', 'l.l_returnflag')} = w.y)
{' UNION ALL '.join(grads)}
"""


@query("logistic_gradient", "M3", _gradient_sql())
def q_logistic_gradient(spark, d):
    from ..operators.learners import logistic_gradient
    li = load(spark, d, "lineitem").select(binary_label().alias("label"), *BINARY_FEATURES)
    li = L.weight_column(li, "label", "cw")
    g = logistic_gradient(li, binary_members()[0], "label", "cw", alpha=1e-4)
    return g.select("feature", r6("grad").alias("grad"))


@query("linreg_closed_form", "M5", f"""
SELECT {r6_sql('regr_slope(p_retailprice, p_size)')} AS slope,
       {r6_sql('regr_intercept(p_retailprice, p_size)')} AS intercept FROM part
""")
def q_linreg_closed_form(spark, d):
    from ..operators.learners import least_squares_1d
    return _round_all(least_squares_1d(load(spark, d, "part"), "p_retailprice", "p_size"))
