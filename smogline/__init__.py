"""smogline: Spark-native operators and jobs for city air-quality time series.

Every operator is a function ``DataFrame -> DataFrame`` (or ``Column -> Column``)
built from the DataFrame API so that Catalyst plans and distributes the work.
"""

__version__ = "0.1.0"
