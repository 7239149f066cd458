"""Board geometry as column expressions: the origin is the house centre, the unit its radius."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import BOARD_X, BOARD_Y_MAX, HOUSE_CX, HOUSE_CY, HOUSE_RADIUS, RINGS


def to_board(sx: Column, sy: Column, orientation: Column, cx: Column | float = HOUSE_CX, cy: Column | float = HOUSE_CY, radius: Column | float = HOUSE_RADIUS) -> tuple[Column, Column]:
    """Board place of a pixel; the bottom orientation mirrors both axes."""
    cx, cy, radius = (v if isinstance(v, Column) else F.lit(float(v)) for v in (cx, cy, radius))
    top = orientation == "top"
    return F.when(top, (sx - cx) / radius).otherwise((cx - sx) / radius), F.when(top, (sy - cy) / radius).otherwise((cy - sy) / radius)


def to_pixel(x: Column, y: Column, orientation: Column, cx: Column | float = HOUSE_CX, cy: Column | float = HOUSE_CY, radius: Column | float = HOUSE_RADIUS) -> tuple[Column, Column]:
    cx, cy, radius = (v if isinstance(v, Column) else F.lit(float(v)) for v in (cx, cy, radius))
    top = orientation == "top"
    return F.when(top, cx + x * radius).otherwise(cx - x * radius), F.when(top, cy + y * radius).otherwise(cy - y * radius)


def board_pixel(x: Column, y: Column, scale: float = 100.0) -> tuple[Column, Column]:
    """Pixel of a drawn board, y upwards, from its left and far edges."""
    return F.floor((x + BOARD_X) * scale).cast("int"), F.floor((F.lit(BOARD_Y_MAX) - y) * scale).cast("int")


def polar(x: Column, y: Column) -> tuple[Column, Column]:
    """Distance, and angle in degrees."""
    return F.sqrt(x * x + y * y), F.degrees(F.atan2(y, x))


def ring(dist: Column) -> Column:
    out = F.lit("outside")
    for name, limit in reversed(RINGS):
        out = F.when(dist < limit, F.lit(name)).otherwise(out)
    return out
