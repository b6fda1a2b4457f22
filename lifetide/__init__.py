"""lifetide — customer-lifetime-value analytics as Spark jobs.

Sub-packages:
  sources    read landed payloads, driver tables, incremental cursors
  functions  column expressions (money, ISO time, recency, confidence ...)
  operators  flatten, dedup, upsert, metrics, reports, quality, model
  plans      named queries over whole tables (used by the entry module / bench)
  streaming  change-event intake with foreachBatch
"""

from lifetide.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
