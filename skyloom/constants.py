"""Fixed values of the data products."""

# Weights of the bands r, i, z, y in the combined image.
BANDS = ("r", "i", "z", "y")
BAND_WEIGHTS = {"r": 0.238, "i": 0.344, "z": 0.283, "y": 0.135}
# Header defaults, taken together if any of the three is missing.
HEADER_DEFAULTS = {"boffset": 1000.0, "bsoften": 1000.0, "exptime": 1.0}
# Geometry, in cell pixels.
CELL_OVERLAP, EDGE_EXCLUSION, PAD_SIZE = 480, 10, 480
EFFECTIVE_OVERLAP = CELL_OVERLAP - EDGE_EXCLUSION
PSF_SIGMA, PSF_RADIUS = 60.0, 470
INSET_LARGE, INSET_SMALL, INSET_NORMAL = 410, 70, 200
SEARCH_RADIUS = 0.2 * 2**0.5
FULL_COVERAGE = 99.9
FOOTPRINT_BUFFER = 150
BATCH_SIZE = 20
# Star magnitudes.
STAR_LIMIT, REPLACE_LIMIT, EPSF_BRIGHT, EPSF_FAINT, STAR_HALF_SIZE, ZERO_POINT = 18.0, 14.0, 13.5, 17.0, 25, 25.0
# Mask bits in order of value; SUSPECT and BURNTOOL share one.
MASK_BITS = (
    ("DETECTOR", 1), ("FLAT", 2), ("DARK", 4), ("BLANK", 8), ("CTE", 16), ("SAT", 32), ("LOW", 64), ("SUSPECT", 128), ("BURNTOOL", 128),
    ("CR", 256), ("SPIKE", 512), ("GHOST", 1024), ("STREAK", 2048), ("STARCORE", 4096), ("CONV.BAD", 8192), ("CONV.POOR", 16384),
)
MASK_SPECIAL = (("MASK.VALUE", 8575), ("MARK.VALUE", 32768))
SAT_BIT = 5
IGNORE_BITS = (12,)
# Sides of a cell, in the order of the flag lists, with steps in x and y.
SIDES = (("top", 0, 1), ("right", 1, 0), ("top_right", 1, 1), ("bottom", 0, -1), ("left", -1, 0), ("bottom_left", -1, -1), ("bottom_right", 1, -1), ("top_left", -1, 1))
#: The arrays that a complete cell has: image, mask and weight of each band.
EXPECTED_ARRAYS = tuple(f"{b}{s}" for b in BANDS for s in ("", "_mask", "_wt"))
