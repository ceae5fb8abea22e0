"""acreline: field-sequence analytics on Spark DataFrames.

Multi-year class rasters become region graphs and polygons, polygons are
joined to boundaries, and two coverages can be scored against each other.
Every step is a function from DataFrame to DataFrame.
"""

__version__ = "0.1.0"
