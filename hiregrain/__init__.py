"""hiregrain: job-posting collection, curation and analytics as Spark jobs."""

import sys

from pyspark import cloudpickle

# Executors need no installed copy: the few Python helpers travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
