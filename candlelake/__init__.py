"""candlelake: daily OHLCV bars through a bronze / silver / gold medallion, built on Spark DataFrames.

Every public function takes and returns DataFrames (or column expressions); nothing is
collected to the driver except one-row scalars such as a high-water mark.
"""

__version__ = "0.1.0"

import logging as _logging

# A library logs; the application decides where it goes.
_logging.getLogger(__name__).addHandler(_logging.NullHandler())
