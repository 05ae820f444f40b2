"""enrichkit: enrichment, profiling and de-identification operators on Spark DataFrames.

Every public function takes and returns DataFrames (or Columns) and keeps the work
inside Spark's planner: no per-row calls to outside services, no driver-side loops.
"""

__version__ = "0.1.0"
