"""Operators of a training-data pipeline: one module per operator, each with its query.

Nothing else in the library imports this subpackage.  Functions that run inside
tasks are pickled by value, so executors need the public libraries only, not a
copy of this package.
"""

import importlib
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_OPERATORS = ("token_ids", "license_scan", "language_id", "packing", "decontaminate", "chat_format", "fingerprint", "line_dedup", "near_dup", "quality", "lexical_search", "whitening", "secret_scan")


def _modules():
    return [importlib.import_module(f"{__name__}.{name}") for name in _OPERATORS]


def queries() -> dict:
    out: dict = {}
    for mod in _modules():
        out.update(mod.QUERIES)
    return out


def oracle_sql() -> dict:
    out: dict = {}
    for mod in _modules():
        out.update(getattr(mod, "ORACLE", {}))
    return out
