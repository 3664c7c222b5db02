"""Operators for building language-model training corpora on Spark.

Each module holds one operator; ``queries`` registers one query per operator
and the corpus pipeline. Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# tasks get the operators' code with their closures, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
