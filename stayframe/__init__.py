"""stayframe: per-entity windowed event analytics on Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` function (chain them with
``DataFrame.transform``).  Only the functions in ``sources`` and
``streaming`` read or write storage.
"""

from stayframe.config import WindowConfig, CLINICAL

__all__ = ["WindowConfig", "CLINICAL"]
