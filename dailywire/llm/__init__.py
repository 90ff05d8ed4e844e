"""Training-data pipeline operators (chat masks, search, mixing, packing, dedup, WARC, toxicity).

Functions of this package travel to the executors by value, so that they run on workers where the
package is not installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
