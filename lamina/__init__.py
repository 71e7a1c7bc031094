"""lamina: a Spark-native medallion analytics library.

Text landed as CSV becomes a partitioned bronze table, bronze becomes a typed and
quality-ruled silver table, silver becomes a star schema with pre-aggregated marts,
and the marts are checked against declared contracts and exported.  Every operator
takes and returns DataFrames.
"""
