"""Star-schema and event-log analytics as PySpark DataFrame plans."""

from lakestar.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]
