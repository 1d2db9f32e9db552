"""starloom: build and maintain an analytical star schema with PySpark.

Every operator is a pure function from DataFrames (plus an explicit run
timestamp) to a lazy DataFrame; nothing is collected on the driver.
"""

__version__ = "0.1.0"
