"""Fixed values and the choices made where the domain leaves them open."""

# Working and equal-area reference systems.
WORKING_CRS = "EPSG:4326"
AREA_CRS = "EPSG:5070"
M2_PER_KM2 = 1_000_000.0

# Region selection defaults.
DEFAULT_SCHEME = "EPA_US"
DEFAULT_LEVEL = 3
OUTPUT_COLUMNS = ["uid", "scheme", "level", "code", "name", "area_km2", "geom"]
CODE_SAMPLE = 25
FILE_SAMPLE = 5

# Default statistics of a zonal run.
DEFAULT_STATS = ["mean", "std", "min", "max"]

# Unit handling.
KELVIN_OFFSET = 273.15

# Choices.
PCT_SUM_EPS = 1e-6            # percent cover must add up to 1 within this
TILE = 256                    # cells per tile side
DOY_HALF_WINDOW = 7           # days either side for day-of-year thresholds
HOT_Q, COLD_Q, DRY_Q = 0.95, 0.05, 0.20
DROUGHT_WINDOWS = (30, 90, 180)
TREND_MONTHS = 60
VOLATILITY_MONTHS = 12
REGIME_MONTHS = 12
REGIME_SIGMAS = 1.0
MAD_SCALE = 1.4826            # makes the MAD comparable to a deviation
GDD_BASE_C = 10.0

# Sides of more bytes than this are never broadcast; they go through a
# shuffle join whose keys are salted.
BROADCAST_BYTES = 64 << 20
SALTS = 32
