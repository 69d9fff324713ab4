"""Land-change analytics on gridded time series, planned by Spark.

Pixels, zones and points are DataFrames: one row for a pixel and date, one
column for a band. Missing values are NULL everywhere inside; NaN and numeric
nodata are converted where data enter (``schema.to_null``) and leave
(``schema.from_null``).
"""
