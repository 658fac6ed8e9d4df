"""Bindings of the four reference tasks to the driver tables, and literal models.

* binary task   -- ``lineitem``: features quantity/price/discount/tax, label
                   ``l_returnflag = 'R'``
* multi-class   -- ``lineitem.l_returnflag`` (A/N/R)
* regression    -- ``part``: ``p_retailprice`` on ``p_size``
* text task     -- ``documents`` with ``labels.quality``
* row order     -- ``events`` (sequence ``event_id``, key ``user_id``)

Literal models are generated from a rule so that both Spark and the SQL
oracle evaluate exactly the same arithmetic; ``*_sql`` helpers print the same
expression for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

BINARY_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
MULTI_CLASSES = ["A", "N", "R"]
SEED = 42
TEST_RATIO = 0.2


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lit_sql(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def linear_sql(model: dict, prefix: str = "") -> str:
    s = lit_sql(model["intercept"])
    for f, w in zip(model["features"], model["coef"], strict=True):
        s = f"({s} + {lit_sql(w)} * {prefix}{f})"
    return s


def sigmoid_sql(z: str) -> str:
    return f"(1.0 / (1.0 + exp(-({z}))))"


def r6_sql(x: str) -> str:
    """Oracle rounding; ``+ 0.0`` turns -0.0 into 0.0 as Spark's round does."""
    return f"(round({x}, 6) + 0.0)"


def binary_members(n: int = 7) -> list[dict]:
    """Seven logistic members over the raw binary features (rule-generated)."""
    return [{"features": BINARY_FEATURES,
             "coef": [0.03 + 0.002 * i, -0.00001 - 0.000001 * i, 3.0 - 0.4 * i, -2.0 + 0.5 * i],
             "intercept": -0.5 + 0.05 * i} for i in range(n)]


def ovr_models() -> dict[str, dict]:
    """One-vs-rest logistic models for the A/N/R return flags."""
    out = {}
    for j, c in enumerate(MULTI_CLASSES):
        out[c] = {"features": BINARY_FEATURES,
                  "coef": [0.02 * (j - 1), 0.000004 * (1 - j), 2.0 * j - 1.5, 1.0 - j],
                  "intercept": -0.7 + 0.2 * j}
    return out


REGRESSION = {"features": ["p_size"], "coef": [9.5], "intercept": 1250.0}

# A literal text model of our own, to check the text scorer.
TEXT_WEIGHTS = {"the": 0.8, "and": 0.6, "of": 0.4, "is": 0.3, "le": -0.7, "la": -0.5,
                "de": -0.6, "der": -0.4, "el": -0.3, "que": -0.2}
TEXT_INTERCEPT = -0.05


def binary_label() -> Column:
    return (F.col("l_returnflag") == "R").cast("int")


BINARY_LABEL_SQL = "CAST(l_returnflag = 'R' AS INTEGER)"


def lineitem_key() -> Column:
    """Composite text key (not unique in the fixtures; ties share a split)."""
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


LINEITEM_KEY_SQL = "(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR))"
