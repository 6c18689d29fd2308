"""Training-data operators: quality, decontamination, dedup, extraction, output.

Nothing else in the library imports this subpackage. Its functions are
pickled by value, so executors need only Spark's own Python environment
(numpy, pyarrow, xxhash, tokenizers), not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
