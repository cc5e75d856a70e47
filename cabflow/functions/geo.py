"""NYC bounding box and the 250 x 400 grid of cells.

Inputs are FloatType columns (the reference stores coordinates as float);
comparisons and arithmetic widen them to double, exactly as the reference
does, so the east edge -73.7 (float) falls *outside* the box.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for identical results.
LON_EAST = -73.7
LON_WEST = -74.05
LAT_NORTH = 41.0
LAT_SOUTH = 40.5
DELTA_LON = 0.0014
DELTA_LAT = 0.00125
NUMBER_OF_GRID_X = 250
NUMBER_OF_GRID_Y = 400


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _d(c) -> Column:
    return _c(c).cast("double")


def in_bbox(lon, lat, west=LON_WEST, east=LON_EAST, south=LAT_SOUTH, north=LAT_NORTH) -> Column:
    """Inclusive box test: not (lon > east or lon < west) and not (lat > north or lat < south)."""
    lo, la = _d(lon), _d(lat)
    return ~((lo > F.lit(east)) | (lo < F.lit(west))) & ~((la > F.lit(north)) | (la < F.lit(south)))


def in_nyc(start_lon, start_lat, end_lon, end_lat) -> Column:
    """Both ride endpoints inside the NYC box."""
    return in_bbox(start_lon, start_lat) & in_bbox(end_lon, end_lat)


def grid_cell(lon, lat, west=LON_WEST, north=LAT_NORTH, dlon=DELTA_LON, dlat=DELTA_LAT,
              nx=NUMBER_OF_GRID_X) -> Column:
    """Cell id = floor((|west| - |lon|) / dlon) + floor((north - lat) / dlat) * nx.

    ``abs`` is taken on the float input before widening (as in the reference);
    the inclusive east edge can give x index ``nx`` (kept as is).
    """
    lo, la = _c(lon), _c(lat)
    x = F.floor((F.lit(abs(west)) - F.abs(lo).cast("double")) / F.lit(dlon))
    y = F.floor((F.lit(north) - la.cast("double")) / F.lit(dlat))
    return (x + y * F.lit(nx)).cast("int")
