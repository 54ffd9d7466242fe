"""seedwright: instruction/answer data from seed text, as Spark jobs."""

from __future__ import annotations

import sys


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so executors need no
    install for the few ``mapInPandas`` helpers it sends."""
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older pickler: rely on an installed package
        pass


_ship_by_value()

__all__ = ["__version__"]
__version__ = "0.1.0"
