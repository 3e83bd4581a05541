"""sifter: instruction-dataset operators on Spark DataFrames.

Every public operator takes and returns DataFrames (or Columns) built from
Spark SQL built-ins, so Catalyst plans them and whole-stage codegen runs them.
Python runs only inside user hooks (custom tokenizer, generator callable,
exact-JSON mode), always as Arrow-batched pandas UDFs.
"""
import sys as _sys

try:  # ship our own code by value so executors need no installed copy
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark or already registered
    pass

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
