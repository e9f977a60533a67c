"""hibiki: a Spark-native analytics engine for parallel-text corpora.

Every operator takes and returns Spark DataFrames (or Columns) and is expressed
in the DataFrame / SQL API, so that Catalyst picks the physical plan.
"""

__version__ = "0.1.0"
