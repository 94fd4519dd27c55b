"""tickweave — daily equity bar analytics on Spark DataFrames.

Every operator is a plain ``DataFrame -> DataFrame`` function that works on
all securities at once (partitioned by ``code``, ordered by ``date``).
Series windows run on bounded row segments (see ``functions.series``) so a
single security with a huge history never lands in one task.
"""

__all__ = ["session", "schemas"]
