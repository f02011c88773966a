"""Market prices and social posts on Spark: tables, streams, speed rows, daily rows."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Python functions and state processors travel with the job: workers need no copy
# of this package on their path.
register_pickle_by_value(sys.modules[__name__])
