"""tidemark: change-log ingestion, keyed state, corpus preparation and
reporting operators expressed as Spark DataFrame transformations.

Every operator is a function ``DataFrame -> DataFrame`` (or returns
``Column`` expressions).  Stateless ones also run unchanged on a
streaming DataFrame.  No data rows are collected to the driver; only
bounded metadata is (day-partition names, touched bucket ids, committed
version numbers, per-batch counters).
"""

from tidemark.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
