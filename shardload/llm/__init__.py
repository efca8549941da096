"""Training-data operators: language id, decontamination, line dedup, licence
scan, binary top-k search, packing, PII, language-model scoring, near-duplicate
grouping and quality classification.  Nothing else in the library imports this
subpackage; its registered queries are in ``queries``."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel with their tasks, so that workers need
# NumPy, PyArrow and the tokenizers but not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
