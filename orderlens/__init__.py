"""Order-economics analytics on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` built from the public
DataFrame / SQL API, so Catalyst plans it and it scales out with the cluster.
"""

from orderlens.params import Params

__all__ = ["Params"]
__version__ = "0.1.0"
