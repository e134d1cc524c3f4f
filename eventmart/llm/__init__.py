"""Operators for training-data pipelines: text, url and vector tables in, DataFrames out.

Functions that run in Python workers are shipped with the job, so that executors need no copy of the
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
