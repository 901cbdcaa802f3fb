"""framesift: curation of image, video and caption tables as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python functions used inside tasks travel with the job, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
