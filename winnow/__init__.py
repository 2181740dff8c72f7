"""winnow: triage of large scored candidate tables on Spark."""

import sys

from pyspark import cloudpickle

# The few Python functions used inside tasks travel with the job, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
