"""Keep tables in sync with Spark, and prove that they are.

Every operator takes and returns DataFrames and stays lazy unless its name says
that it writes. See README.md for the list of operators and how each one scales.
"""

from tidemark.spec import SyncSpec, TargetSpec

__all__ = ["SyncSpec", "TargetSpec"]
