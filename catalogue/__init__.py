"""Registered queries and their SQL twins, grouped by family.

The given tables hold no polygons or rasters; ``standins`` derives them.
"""
