"""All queries over the given tables; ``load`` fills the registry."""

import sys
from importlib import import_module

from pyspark import cloudpickle

# step functions of the live queries travel by value, as those of braidline.streaming do
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SECTIONS = ("joins", "clocks", "relations", "labels", "scalars", "statistics", "io", "live")


def load() -> None:
    for section in SECTIONS:
        import_module(f"braidline.queries.{section}")
