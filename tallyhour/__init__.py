"""tallyhour: Spark-native hourly revenue consolidation.

Five revenue sources (first-party events, GAM transfer, demand-partner reports,
SSP reports, syndication) are pulled incrementally, normalised, grouped to an
hourly 13-dimension grain, allocated or exploded, and merged into one hourly
fact table, followed by a data-quality suite. Every step is a DataFrame
transformation built from Spark built-in functions.
"""

from tallyhour.schemas import GRAIN, METRICS, SSOT_SCHEMA, WATERMARK_COLS, AUDIT_COLS  # noqa: F401
from tallyhour.session import build_session, checkpoint_dir  # noqa: F401

__all__ = ["GRAIN", "METRICS", "SSOT_SCHEMA", "WATERMARK_COLS", "AUDIT_COLS",
           "build_session", "checkpoint_dir"]
