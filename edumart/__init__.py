"""edumart — Spark-native survey/registry marts.

Reads anonymised respondent extracts (per-question files keyed by course)
plus course and institution registries, and builds per-course and
per-institution profile marts (score means, age statistics, answer-count
cross-tabs) for every edition in one Spark job.

Layout:
  functions/  column expressions (rounding, missing-category fill, NA tokens)
  sources/    delimited / mart / layer readers, sinks, manifests, routing
  operators/  de-dup, joins, column helpers, cross-tabs, statistics, checks
  plans/      the marts and the named queries on the driver tables
  streaming/  incremental landing of newly arrived extract files
"""

__version__ = "0.1.0"
