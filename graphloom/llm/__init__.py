"""Training-data operators: text corpora in, decisions and filtered corpora out.

Nothing else in the package imports this subpackage. Every operator takes and returns
DataFrames; state that outlives one job is written under the shared checkpoint folder.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
