"""mapfold: a Spark-native engine that builds map layers for many areas at once.

Features (points, lines, polygons, tagged elements, pixels) are joined with
areas (countries or sub-national units) as plain DataFrame plans.  Geometry is
kept in fixed-point integer micro-degrees so that predicates are exact.
"""

from mapfold.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
