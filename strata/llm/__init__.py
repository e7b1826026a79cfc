"""Operators for preparing training data: decontamination, mixing, deduplication, quality,
token counts, URL lists, embeddings, web archives, toxicity, repetition, shards and filter audits.

Nothing else in the library imports this subpackage. Its functions are sent to executors by value; what they
broadcast is sent by reference, so executors need this package too, with numpy, pyarrow and xxhash.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
