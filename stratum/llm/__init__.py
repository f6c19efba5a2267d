"""Training-data operators over ``documents``-like tables. Nothing else in the library imports this subpackage."""
import sys

from pyspark import cloudpickle

# functions of this subpackage travel to the executors with their code, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
