"""custlens — customer analytics as Spark DataFrame operators.

Every public operator is a function ``DataFrame -> DataFrame`` (or a small
dict of DataFrames for report sets) built only from the DataFrame / SQL API
and ``pyspark.ml``. Nothing is collected to the driver except bounded
configuration (product lists, pack names, centroids).
"""

from custlens.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
