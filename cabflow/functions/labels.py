"""Driving-style label and text formats of output records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: label per band of
# int(erraticness / 2.5): 0 -> calm, 1 -> busy, anything else -> crazy.
STYLE_BAND = 2.5
STYLE_LABELS = ("calm", "busy", "crazy")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def style_label(erraticness) -> Column:
    """``(int)(x / 2.5)``: 0 calm, 1 busy, else crazy (truncation toward zero)."""
    band = (_c(erraticness).cast("double") / F.lit(STYLE_BAND)).cast("int")
    return (F.when(band == 0, F.lit(STYLE_LABELS[0]))
             .when(band == 1, F.lit(STYLE_LABELS[1]))
             .otherwise(F.lit(STYLE_LABELS[2])))


def segment_line(car_id, start_ms, length, max_speed, label) -> Column:
    """``carId,startTime,<length> events,<maxSpeed> kph,<label>``."""
    return F.concat(_c(car_id).cast("string"), F.lit(","), _c(start_ms).cast("string"), F.lit(","),
                    _c(length).cast("string"), F.lit(" events,"),
                    _c(max_speed).cast("float").cast("string"), F.lit(" kph,"), _c(label))
