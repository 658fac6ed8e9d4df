"""rivulet: DataFrame-in / DataFrame-out operators for incremental ML data
pipelines on Spark SQL, Spark ML and Structured Streaming.

Sub-packages
------------
sources    CSV scans with dirty headers / preambles / bad lines, sinks,
           file inventory and manifests, model parameter tables.
operators  contract + quarantine, audit + dedup (exact and Bloom), labels and
           holdout splits, scaling and kernel maps, text features, learners,
           scorers and evaluation metrics.
functions  column-expression helpers shared by the operators.
streaming  Structured Streaming versions of ingestion, dedup, audit,
           histograms, moments, quarantine, scoring and online fitting.
plans      bindings of the operators to the driver tables (queries + oracle
           SQL) and the four end-to-end training / ETL / scoring flows.
"""

__version__ = "0.1.0"
