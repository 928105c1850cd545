"""Training-data operators: token counts, packing, fingerprints, toxicity, HTML extraction,
near-duplicates, licence scans, line dedup, source mixing and nearest neighbours.

Nothing else in the package imports this subpackage; ``queries`` holds the registered
queries and their SQL.
"""

import sys

from pyspark import cloudpickle

# functions that run inside tasks travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
