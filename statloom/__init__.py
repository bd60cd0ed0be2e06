"""statloom: automated tabular analytics expressed as Spark DataFrame plans."""

from pyspark import cloudpickle as _cloudpickle

from statloom.functions import distributions as _distributions
from statloom.functions import trees as _trees

# The vectorised helpers below run inside Python workers. Shipping them by value
# means executors do not need this package on their import path.
_cloudpickle.register_pickle_by_value(_distributions)
_cloudpickle.register_pickle_by_value(_trees)

__version__ = "0.1.0"
