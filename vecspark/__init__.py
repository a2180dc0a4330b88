"""vecspark: text, embedding and vector-table analytics as Spark DataFrame jobs.

Subpackages
-----------
sources    readers and writers (text corpora, labelled vectors, embedding sets, reports)
functions  column expressions (tokeniser, packed-vector arithmetic, formula-made weights)
operators  DataFrame -> DataFrame operators (text, windows, tensors, embeddings, metrics,
           layers, scoring, training)
plans      the registered queries and their SQL oracles
streaming  micro-batch adapters that run the batch operators over a stream
"""

from pyspark import cloudpickle as _cloudpickle
import sys as _sys

# Functions of this package run inside Python workers (mapInPandas, applyInPandas).
# Pickle them by value so executors do not need the package installed.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__all__ = ["session"]
