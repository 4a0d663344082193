"""radiolens: Spark-native analytics on per-call radio measurement records.

Decode time-stamped call records, explode their measurement reports and
bearer blocks into rows, compute per (serving, neighbour) cell pair the
means, variances and covariance of signal strength -- in one pass, as
mergeable partial sums, or incrementally on a stream -- derive the
cell-interference graph and its connected components, and write long
tables, text reports or replaceable partitions.  Every operator is a
``DataFrame -> DataFrame`` function built from Spark SQL expressions.
"""

__version__ = "0.1.0"
