"""Search-log, rating, device and learning analytics written as Spark DataFrame functions."""

from riverglass.session import build_session, shared_dir, work_dir

__all__ = ["build_session", "shared_dir", "work_dir"]
