"""gridops: Spark-native renewable-energy operations analytics over gridded weather data.

Every public function takes and returns lazy DataFrames; nothing is collected
to the driver. See README.md for the module map.
"""

from gridops.params import Params

__all__ = ["Params"]
