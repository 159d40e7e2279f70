"""carelake — set-based longitudinal patient records on Spark.

Builds one nested record per person from many relational tables, computes
pre-calculated flags for an explicit ``as_of`` date, lists visits by care
setting, evaluates data-driven quality measures over nested arrays, and keeps
records current by routing table changes to the affected persons (batch or
Structured Streaming).  Everything is DataFrame / Spark SQL; no Python UDFs.
"""

__version__ = "0.1.0"
