"""ticketloom: support-ticket text analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package travel to the Python workers by value, so they need not have
# the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
