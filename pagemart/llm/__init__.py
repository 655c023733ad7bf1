"""Operators of a training-data pipeline. Nothing outside this package imports it."""

import importlib
import sys

from pyspark import cloudpickle

# Executors get these functions with the job; they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

for _name in ("quality", "bpe", "packing", "simhash", "linededup", "langid", "tokencount", "chat", "html_text", "ann", "divergence", "archives", "spelling"):
    importlib.import_module(f"{__name__}.{_name}")

from pagemart.llm.base import ORACLES, QUERIES  # noqa: E402

__all__ = ["ORACLES", "QUERIES"]
