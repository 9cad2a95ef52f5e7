"""Vegetation and climate analytics on Spark DataFrames.

Everything is a function from DataFrames to a DataFrame, keyed by ``aoi_id``
(area of interest).  Missing values are NULL, never NaN.
"""

__version__ = "0.1.0"
