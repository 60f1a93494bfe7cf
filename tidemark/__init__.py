"""Tidemark: a PySpark engine for filing feeds, news-event dumps and fund constituent lists."""

import sys

from pyspark import cloudpickle

# Executors need not have the package installed: its functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
