"""Tidemart: a layered commerce warehouse on Spark, for batch and streams.

Every operator is a function from DataFrame to DataFrame.  Where batch and
streaming both make sense the same function takes either; the few operators
that need per-key state on a stream live in ``tidemart.streaming``.
"""
