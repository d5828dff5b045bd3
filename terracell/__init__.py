"""Region and raster-cell analytics as Spark DataFrame jobs.

Regions are polygon rows, rasters are long cell tables, and every operator
takes DataFrames and returns a DataFrame.
"""
