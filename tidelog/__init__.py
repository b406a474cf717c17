"""tidelog: change-data-capture analytics as ordinary Spark plans."""

from tidelog.session import configure, scratch_dir

__all__ = ["configure", "scratch_dir"]
