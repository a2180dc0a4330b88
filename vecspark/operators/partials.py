"""Aggregates whose state is a vector or matrix: one state a task, merged in a tree.

A kernel folds all Arrow batches of a task into one state and emits it as one row, so what is shuffled
is one row a task whatever the number of table rows. The rows are dealt to ``FAN`` tasks that merge them as
they stream in, and one last task merges the ``FAN`` results; no task holds more than two states.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

FAN = 16
_ROW = "state binary"


def _emit(state):
    return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(state)], pa.binary())], names=["state"])


def merged_state(df: DataFrame, fold: Callable, merge: Callable) -> DataFrame:
    """At most one row ``<state>``: ``fold(state or None, batch)`` over every batch of ``df`` and
    ``merge(state, state)`` over the tasks. ``merge`` must be associative and commutative. No row for an empty table."""
    def task(batches):
        state = None
        for b in batches:
            if b.num_rows:
                state = fold(state, b)
        if state is not None:
            yield _emit(state)

    def level(batches):
        state = None
        for b in batches:
            for s in b.column(0).to_pylist():
                one = pickle.loads(s)
                state = one if state is None else merge(state, one)
        if state is not None:
            yield _emit(state)

    return df.mapInArrow(task, _ROW).repartition(FAN).mapInArrow(level, _ROW).repartition(1).mapInArrow(level, _ROW)


def rows_of_state(states: DataFrame, rows: Callable, schema: str) -> DataFrame:
    """The rows (a record batch) that ``rows(state)`` makes of the merged state."""
    def run(batches):
        for b in batches:
            for s in b.column(0).to_pylist():
                yield rows(pickle.loads(s))
    return states.mapInArrow(run, schema)
