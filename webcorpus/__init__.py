"""Spark-native engine that turns fetched web pages into a chunked text corpus."""

import sys

from pyspark import cloudpickle

from webcorpus.config import CrawlConfig
from webcorpus.session import get_session

# Functions that run in Python workers travel with their tasks, so executors
# need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["CrawlConfig", "get_session"]
