"""Ground-motion raster analytics on Spark DataFrames.

A raster is a table of pixels ``(row, col, value)``, optionally led by key
columns such as ``raster_id`` or ``scene_id``.  Every operator takes those key
columns through its ``by`` argument, so one call works on one raster or on a
whole archive of rasters.
"""

import sys

from pyspark import cloudpickle

from groundswell.config import PRESETS, Settings

# Task functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["PRESETS", "Settings"]
