"""Thresholds and vocabularies of the domain.

Fixed values: results must equal those of the data's producers.
"""

END = ["event_id", "match_id", "end_number"]
SHOT = [*END, "shot_number"]
MAX_STONES = 8
SHOTS_PER_END = 16

#: Distances in units of the house radius.
TRACK_DIST = 0.13
GHOST_DIST = 0.20
DEDUP_RADIUS = 0.08
MATCH_RADIUS = 0.08
NEAR_ZERO = 0.05
ZONE_LOW = 0.8
PRESSURE = 0.05
LINK_TOLERANCE = 1e-4
NOISE_DIST = 0.05
COVERAGE_FLOOR = 50.0

#: House and stone pixels of a shot image at 300 dpi.
HOUSE_CX, HOUSE_CY, HOUSE_RADIUS = 161.0, 171.0, 112.0
AREA_MIN, AREA_MAX, FILL_RATIO, GT_AREA_FACTOR = 80.0, 600.0, 0.45, 0.5
PLAY_TOP, PLAY_BOTTOM = 15.0, 0.93
RADIUS_BAND = 0.25
RING_PIXELS = 6
CROP_HEIGHT = 686.0
#: Hues (0-180) of stones: half a window, saturation and value of a pixel that counts, pixels of an indicator.
HUE_HALF, HUE_SATURATION, HUE_VALUE, HUE_PIXELS = 12.0, 60.0, 60.0, 10
#: Windows of hues where a page has no indicator.
STATIC_HUES = {("red", 1): (0, 10), ("red", 2): (160, 180), ("yellow", 1): (10, 35)}
CALIBRATION_DEVIATION, SUSPECT_DIST = 0.10, 1.5
SCALE = 300 / 72

#: Graph features.
SPATIAL_DIST, END_NORM, SHOT_NORM = 2.0, 10.0, 16.0
SHOT_TYPES = ["Draw", "Guard", "Take-out", "Raise", "Hit and Roll", "Wick / Soft Peeling"]
TRAIN_MAX_YEAR, VAL_YEAR = 2023, 2024
MIXED_DOUBLES = "mxd"
MIN_YEAR = 2013

RINGS = [("button", 0.083), ("4-foot", 0.333), ("8-foot", 0.667), ("12-foot", 1.0)]
BOARD_X, BOARD_Y_MIN, BOARD_Y_MAX = 1.44, -1.53, 4.60

#: Verdicts: metric, whether a value is good at or below (or at or above) the threshold.
VERDICTS = [
    ("spurious_id_rate", "max", 0.02),
    ("id_continuity_rate", "min", 0.98),
    ("slot_swap_rate", "max", 0.0),
    ("stone_count_consistency_rate", "min", 0.99),
    ("delivery_anomaly_rate", "max", 0.10),
    ("cap_pressure_rate", "max", 0.10),
    ("threshold_zone_fraction", "max", 0.05),
    ("near_zero_fraction", "min", 0.90),
    ("still_stone_p95_displacement", "below", 0.13),
    ("separation_ratio", "min", 5.0),
]
REGRESSION = {"min_f1": 97.0, "max_pos_err_p95_norm": 0.05, "min_ghost_recall": 85.0, "max_f1_regression": 2.0, "max_ghost_recall_regression": 5.0}
