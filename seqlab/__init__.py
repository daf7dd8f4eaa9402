"""seqlab: sequence preparation, model fitting and evaluation as Spark jobs.

Every public function takes DataFrames (or Columns) and returns DataFrames
(or Columns) lazily; nothing is collected to the driver except model
coefficients and bounded metric rows.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this package that run inside tasks (mapInPandas,
# applyInPandas) are shipped by value, so executors need no installed copy.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from seqlab.session import checkpoint_dir, get_session  # noqa: E402

__all__ = ["get_session", "checkpoint_dir"]
