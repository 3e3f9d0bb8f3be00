"""haulmark: bulk-transfer planning and integrity checks as Spark DataFrame jobs.

File trees, object stores, manifests, copy results and transfer logs are plain DataFrames (see
``haulmark.schemas``).  The sub-packages:

* ``functions``  column helpers (paths, digests, sizes, time bounds)
* ``sources``    listings, manifests, stored plans, failure logs, file systems
* ``operators``  diff, verification, sync selection, work layout, digest and copy jobs
* ``plans``      whole jobs put together from the operators
* ``streaming``  the bandwidth monitor as a Structured Streaming job
"""

import sys

from pyspark import cloudpickle

# Task code travels with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
