"""Data quality, enrichment and housing-market analytics on Spark DataFrames and streams."""

from hearthline.session import build_session, configure, scratch_path, shared_dir

__all__ = ["build_session", "configure", "scratch_path", "shared_dir"]
