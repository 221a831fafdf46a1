"""Disclosure analytics on Spark.

Plain functions ``DataFrame -> DataFrame`` and ``Column -> Column``; chain them
with ``df.transform(fn, ...)``.
"""

__version__ = "0.1.0"
