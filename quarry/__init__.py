"""quarry: batch analytics on Spark DataFrames.

Tables, matrices (as cells), graphs (as edge tables) and texts all stay
DataFrames.  Operators return lazily planned DataFrames, but for the iterative
ones (``bfs``, ``kmeans``, ``linreg_gd``), which run their rounds when called and
return a scan of what they wrote.  The physical strategy is left to Catalyst and
adaptive query execution.
"""

from quarry.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]
