"""Shelfmark: bibliographic records to searchable vector tables, on Spark."""

import sys

from pyspark import cloudpickle

from shelfmark.session import build_session, materialize, shared_dir

# Functions of this package travel to executors by value, so a cluster needs
# no copy of it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "materialize", "shared_dir"]
