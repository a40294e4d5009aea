"""Web-crawl archives to a clean single-language corpus, on Spark."""

from .session import configure, shared_dir, spread, work_path

__all__ = ["configure", "shared_dir", "spread", "work_path"]
