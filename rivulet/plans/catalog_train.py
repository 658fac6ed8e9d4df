"""Registered queries: training by epochs, with the trace of the weights.

Each query trains by exact gradient steps (``batch=None``: one step per task,
mixed), stops after the first epochs and goes on from the stored versions; the
oracle recomputes every epoch's weights from the epoch before.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import r6, unit_hash_sql
from ..operators import incremental as IN
from ..operators import labels as L
from ..operators import learners as LR
from ..operators import text as TX
from ..session import scratch_path
from .catalog_learn import scaled_train
from .catalog_model import TRAIN_WHERE_SQL, moments_sql, scaled_select_sql
from .catalog_text import BOW_CTE, TEST_DOC_SQL
from .fixtures import (BINARY_FEATURES, BINARY_LABEL_SQL, LINEITEM_KEY_SQL, MULTI_CLASSES, SEED, TEST_RATIO, lineitem_key,
                       lit_sql, load, r6_sql)
from .registry import query

EPOCHS, STOP = 4, 2
RATE = 0.5
N_MEMBERS = 3


def resumed(spark, rows, learner, name, epochs=EPOCHS):
    """The trace of a training that stops after ``STOP`` epochs and is gone on with by another trainer."""
    path = scratch_path(spark, name)
    IN.train(rows, learner, path, STOP)
    return IN.train(rows, learner, path, epochs).table().select("version", "output", "feature", r6("coef").alias("coef"))


def trace_sql(rows: str, features: list[str], outputs: dict[str, tuple[str, str]], loss: str, lr: float, alpha: float,
              epochs: int = EPOCHS, rounded: bool = True) -> str:
    """Weights after every epoch of exact gradient steps; outputs: name -> (target, weight) over the columns of ``rows``."""
    names = [*features, "_intercept"]
    cells = {(o, f): f"w{k}_{j}" for k, o in enumerate(outputs) for j, f in enumerate(names)}
    ctes = [f"r AS ({rows})", "e0 AS (SELECT " + ", ".join(f"CAST(0 AS DOUBLE) AS {c}" for c in cells.values()) + ")"]
    for e in range(1, epochs + 1):
        resid = []
        for k, (o, (target, weight)) in enumerate(outputs.items()):
            z = " + ".join([f"{cells[o, f]} * {f}" for f in features] + [cells[o, "_intercept"]])
            guess = f"1.0 / (1.0 + exp(-({z})))" if loss == "log" else f"({z})"
            resid.append(f"({guess} - {target}) * {weight} AS d{k}")
        step = []
        for (o, f), c in cells.items():
            d = f"d{list(outputs).index(o)}"
            grad = f"avg({d} * {f})" if f != "_intercept" else f"avg({d})"
            shrink = f"any_value({c}) * {lit_sql(1 - lr * alpha)}" if f != "_intercept" else f"any_value({c})"
            step.append(f"{shrink} - {lit_sql(lr)} * {grad} AS {c}")
        ctes.append(f"s{e} AS (SELECT r.*, p.*, {', '.join(resid)} FROM r, e{e - 1} p)")
        ctes.append(f"e{e} AS (SELECT {', '.join(step)} FROM s{e})")
    out = [f"SELECT CAST({e} AS INTEGER) AS version, '{o}' AS output, '{f}' AS feature, {r6_sql(c) if rounded else c} AS coef FROM e{e}"
           for e in range(1, epochs + 1) for (o, f), c in cells.items()]
    return "WITH " + ",\n".join(ctes) + "\n" + " UNION ALL ".join(out)


SCALED_ROWS_SQL = f"""SELECT {scaled_select_sql()}, l_returnflag, {BINARY_LABEL_SQL} AS y, {LINEITEM_KEY_SQL} AS k,
  count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY l_returnflag = 'R')) AS cw
  FROM lineitem l, {moments_sql()} m WHERE {TRAIN_WHERE_SQL}"""


def poisson_weight_sql(key: str, seed: int) -> str:
    """Poisson(1) multiplicity of a seeded key hash, as ``learners.poisson_weight``."""
    import math

    u, out, cdf, term = unit_hash_sql(key, seed), [], 0.0, math.exp(-1.0)
    for k in range(12):
        cdf += term
        out.append(f"WHEN {u} < {lit_sql(cdf)} THEN {k}.0")
        term /= k + 1
    return f"(CASE {' '.join(out)} ELSE 12.0 END)"


@query("train_logistic_epochs", "M3,M10", lambda: trace_sql(
    SCALED_ROWS_SQL, BINARY_FEATURES, {"0": ("y", "cw")}, "log", RATE, LR.ALPHA))
def q_train_logistic_epochs(spark, d):
    tr, _ = scaled_train(spark, d)
    rows = IN.dense_rows(tr, BINARY_FEATURES, [F.col("label")], [F.col("cw")])
    return resumed(spark, rows, IN.Learner("log", tuple(BINARY_FEATURES), lr=RATE), "m3")


@query("train_ensemble_epochs", "M4,M10", lambda: trace_sql(
    SCALED_ROWS_SQL, BINARY_FEATURES, {str(i): ("y", f"{poisson_weight_sql('k', SEED + i)} * cw") for i in range(N_MEMBERS)},
    "log", RATE, LR.ALPHA))
def q_train_ensemble_epochs(spark, d):
    """Members of an ensemble trained in one pass, each with its own bootstrap weight for a row."""
    tr, _ = scaled_train(spark, d)
    weights = [LR.poisson_weight(lineitem_key(), SEED + i) * F.col("cw") for i in range(N_MEMBERS)]
    rows = IN.dense_rows(tr, BINARY_FEATURES, [F.col("label")] * N_MEMBERS, weights)
    learner = IN.Learner("log", tuple(BINARY_FEATURES), tuple(map(str, range(N_MEMBERS))), lr=RATE)
    return resumed(spark, rows, learner, "m4")


@query("train_ovr_epochs", "M6,M10", lambda: trace_sql(
    SCALED_ROWS_SQL, BINARY_FEATURES, {c: (f"CAST(l_returnflag = '{c}' AS INTEGER)", "1.0") for c in MULTI_CLASSES},
    "log", RATE, LR.ALPHA))
def q_train_ovr_epochs(spark, d):
    """One-vs-rest over the global class list: all classes learn in one pass."""
    tr, _ = scaled_train(spark, d)
    classes = L.collect_classes(tr, "l_returnflag")
    rows = IN.dense_rows(tr, BINARY_FEATURES, [(F.col("l_returnflag") == c).cast("double") for c in classes])
    return resumed(spark, rows, IN.Learner("log", tuple(BINARY_FEATURES), tuple(classes), lr=RATE), "m6")


@query("train_linear_epochs", "M5,M10", lambda: trace_sql(
    "SELECT p_size / 50.0 AS size, p_retailprice / 1000.0 AS y FROM part", ["size"], {"0": ("y", "1.0")}, "squared", RATE, LR.ALPHA))
def q_train_linear_epochs(spark, d):
    part = load(spark, d, "part").select((F.col("p_size") / F.lit(50.0)).alias("size"), (F.col("p_retailprice") / F.lit(1000.0)).alias("y"))
    rows = IN.dense_rows(part, ["size"], [F.col("y")])
    return resumed(spark, rows, IN.Learner("squared", ("size",), lr=RATE), "m5")


@query("train_sgd_minibatch", "M3,M5,M10", """
SELECT * FROM (VALUES ('logistic', true, true), ('linear', true, true)) v(model, better_than_start, resumed_alike)
""")
def q_train_sgd_minibatch(spark, d):
    """Mini-batch SGD: the loss is below that of zero weights, and going on equals not having stopped."""
    tr, _ = scaled_train(spark, d)
    part = load(spark, d, "part").select((F.col("p_size") / F.lit(50.0)).alias("size"), (F.col("p_retailprice") / F.lit(1000.0)).alias("y"))
    out = []
    for name, frame, feats, label, loss in (("logistic", tr.withColumn("y", F.col("label")), BINARY_FEATURES, "y", "log"),
                                            ("linear", part, ["size"], "y", "squared")):
        paths = [scratch_path(spark, "m10") for _ in range(2)]
        once = LR.fit_sgd(frame, feats, label, loss, epochs=3, batch=64, path=paths[0])
        LR.fit_sgd(frame, feats, label, loss, epochs=1, batch=64, path=paths[1])
        again = LR.fit_sgd(frame, feats, label, loss, epochs=3, batch=64, path=paths[1])
        alike = max(abs(a - b) for a, b in zip([*once["coef"], once["intercept"]], [*again["coef"], again["intercept"]], strict=True)) < 1e-9
        z = F.lit(once["intercept"])
        for f, c in zip(feats, once["coef"], strict=True):
            z = z + F.lit(c) * F.col(f)
        y = F.col(label)
        score = [F.log(1 + F.exp(z)) - y * z, F.lit(0.6931471805599453)] if loss == "log" else [(z - y) * (z - y), y * y]
        out.append(frame.agg(F.avg(score[0]).alias("a"), F.avg(score[1]).alias("b")).select(
            F.lit(name).alias("model"), (F.col("a") < F.col("b")).alias("better_than_start"), F.lit(alike).alias("resumed_alike")))
    return out[0].unionByName(out[1])


def _pa_sql(epochs: int) -> str:
    """Weights of averaged PA-I: every document's step from the epoch's first weights, and their mean added."""
    ctes = [f"""l AS (SELECT d.doc_id, 2.0 * l.quality - 1 AS y FROM documents d JOIN labels l ON d.doc_id = l.doc_id
               WHERE d.text IS NOT NULL AND l.quality IS NOT NULL AND NOT ({TEST_DOC_SQL.replace('doc_id', 'd.doc_id')}))""",
            "q AS (SELECT doc_id, sum(value * value) AS sq FROM bow GROUP BY doc_id)",
            "n AS (SELECT count(*) AS n FROM l)",
            "e0 AS (SELECT CAST(-1 AS BIGINT) AS bucket, CAST(0 AS DOUBLE) AS w)"]
    for e in range(1, epochs + 1):
        ctes += [f"f{e} AS (SELECT b.doc_id, sum(b.value * p.w) AS f FROM bow b JOIN e{e - 1} p ON p.bucket = b.bucket GROUP BY b.doc_id)",
                 f"""t{e} AS (SELECT l.doc_id, l.y * CASE WHEN coalesce(q.sq, 0) > 0 THEN least(1.0, greatest(0.0, 1.0 - l.y * (
                     coalesce(f.f, 0) + (SELECT w FROM e{e - 1} WHERE bucket = -1))) / q.sq) ELSE 0 END AS t
                     FROM l LEFT JOIN q ON q.doc_id = l.doc_id LEFT JOIN f{e} f ON f.doc_id = l.doc_id)""",
                 f"""m{e} AS (SELECT b.bucket, sum(t.t * b.value) AS w FROM bow b JOIN t{e} t ON t.doc_id = b.doc_id GROUP BY b.bucket
                     UNION ALL SELECT -1, sum(t) FROM t{e})""",
                 f"""e{e} AS (SELECT coalesce(p.bucket, m.bucket) AS bucket, coalesce(p.w, 0) + coalesce(m.w, 0) / n.n AS w
                     FROM e{e - 1} p FULL JOIN m{e} m ON m.bucket = p.bucket, n)"""]
    return BOW_CTE + ",\n" + ",\n".join(ctes) + f"\nSELECT bucket, {r6_sql('w')} AS weight FROM e{epochs} WHERE w <> 0 OR bucket = -1"


def labelled_bow(spark, d):
    """Bags of words and labels of the documents outside the held-out share."""
    lab = load(spark, d, "labels").select("doc_id", "quality")
    docs = load(spark, d, "documents").select("doc_id", "text").where(~L.holdout_flag("doc_id", TEST_RATIO, SEED))
    return TX.with_bow(docs.join(lab, "doc_id"), "text").select("doc_id", "bow", "quality")


@query("train_pa_epochs", "M9,M10", lambda: _pa_sql(2))
def q_train_pa_epochs(spark, d):
    """Passive-Aggressive weights after two epochs of averaged steps."""
    found = LR.fit_passive_aggressive(labelled_bow(spark, d), None, "doc_id", "quality", epochs=2, c=1.0, batch=None)
    return found.select("bucket", r6("weight").alias("weight"))
