"""txlens — card-transaction analytics as lazy Spark DataFrame operators.

Every public operator is a function ``DataFrame -> DataFrame`` (or a small
dataclass of DataFrames for graphs).  Nothing is collected to the driver
except one-row statistics; Catalyst/AQE choose join and shuffle strategies.

Sub-packages:
  sources    readers, writers, catalog helpers, adapters from the test tables
  functions  reusable Column expressions (casts, calendar parts, ratios)
  operators  cleaning, trends, behaviour, labelling, spatial, graph, ml
  plans      the registry of named queries and their SQL oracles
  streaming  incremental (file-stream) version of the cleaning job
"""

from txlens.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
__version__ = "0.1.0"
