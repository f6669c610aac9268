"""Lifecycle tracking on Spark: where is every entity in its process, and for how long."""

import sys

from pyspark import cloudpickle

from stagetrace.model import (  # noqa: F401
    FORWARD,
    LAST_WINS,
    STATES,
    TRACKED_TYPES,
    TransitionTable,
)

# Functions that run inside tasks travel with their code; executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
