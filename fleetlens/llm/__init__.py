"""Training-data operators (WARC, tokens, quality, duplicates, models, search) as Spark jobs.

Nothing else in the library imports this subpackage. Worker functions are pickled by value, so an
executor needs no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
