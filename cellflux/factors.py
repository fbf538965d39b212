"""Coefficient tables used by the inventory and conversion jobs.

FIXED VALUES: every number below must equal the published method for
results to match; they are listed plainly and in their natural order.
Users may pass their own tables to the operators instead.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES - particle counter, counts to mass
# ---------------------------------------------------------------------------
# Humidity correction factor by closed humidity band (percent): (low, high, factor)
HUMIDITY_BANDS = [
    (0, 19, 10.1),
    (20, 24, 8.75),
    (25, 29, 8.0),
    (30, 34, 8.0),
    (35, 39, 8.0),
    (40, 44, 7.0),
    (45, 49, 6.0),
    (50, 54, 5.75),
    (55, 59, 5.5),
    (60, 64, 5.5),
    (65, 69, 3.5),
    (70, 74, 3.5),
    (75, 79, 3.75),
    (80, 84, 2.25),
    (85, 89, 1.5),
    (90, 94, 0.825),
    (95, 100, 0.525),
]
# counts per 0.01 cubic foot to per cubic metre, then particle mass per count
COUNT_TO_M3 = 3531.5
MASS_PM25 = 5.89e-7
MASS_PM10 = 1.21e-4
HUMIDITY_SCALE = 0.01

# ---------------------------------------------------------------------------
# FIXED VALUES - road traffic and windblown dust
# ---------------------------------------------------------------------------
# road category: (category total length, traffic share weight)
ROAD_WEIGHTS = {
    "trunk": (263.778046, 0.38),
    "primary": (355.954679, 0.28),
    "secondary": (368.126161, 0.15),
    "tertiary": (2180.144677, 0.13),
    "residential": (1334.340583, 0.06),
}
ROAD_LENGTH_SCALE = 100.0  # clipped length is stored x100
ROAD_FACTORS = {"pm25": 12181409.28378, "pm10": 2783466.98622}
ROAD_DAYS = 365
DUST_FACTORS = {"pm25": 918115910.4, "pm10": 3842589254.4}

# ---------------------------------------------------------------------------
# FIXED VALUES - buses
# ---------------------------------------------------------------------------
BUS_FACTOR = 1.075
BUS_DAYS = 365
BUS_SPLIT = {"pm25": 0.814, "pm10": 0.278}

# ---------------------------------------------------------------------------
# FIXED VALUES - industry
# ---------------------------------------------------------------------------
INDUSTRY_DAYS = 365

# ---------------------------------------------------------------------------
# FIXED VALUES - residential fuel use
# ---------------------------------------------------------------------------
# fuel: (rural rate, urban rate)
FUEL_RATES = {
    "kerosene": (0.613, 0.551),
    "wood": (19.271, 3.686),
    "coal": (0.002, 0.0),
    "lpg": (0.948, 2.17),
}
# pollutant: {fuel: factor}
FUEL_FACTORS = {
    "pm25": {"wood": 1.50, "lpg": 0.33, "coal": 12.20, "kerosene": 1.9},
    "pm10": {"wood": 15.30, "lpg": 2.1, "coal": 20.0, "kerosene": 1.95},
}
# household size classes 1..6 weigh by their size; the 7th term uses class 1 with weight 9
HOUSEHOLD_SIZE_WEIGHTS = [1, 2, 3, 4, 5, 6]
HOUSEHOLD_LAST_WEIGHT = 9
RESIDENTIAL_PERIOD_SCALE = 12.16

# ---------------------------------------------------------------------------
# FIXED VALUES - unit conversion and global field
# ---------------------------------------------------------------------------
SHORT_TON_KG = 907.185
SECONDS_PER_YEAR = 3.15569e7
KM2_M2 = 1e6
FIELD_EPOCH = "1970-01-01"
FIELD_YEAR = 2010
FIELD_ATTRS = {
    "emi_pm": {"units": "kg m-2 s-1", "long_name": "emissions of particulate matter"},
    "time": {"standard_name": "time", "long_name": "time", "units": "days since 1970-01-01T00:00:00", "calendar": "standard"},
    "lat": {"standard_name": "latitude", "long_name": "latitude", "units": "degrees_north"},
    "lon": {"standard_name": "longitude", "long_name": "longitude", "units": "degrees_east"},
}

# ---------------------------------------------------------------------------
# FIXED VALUES - model input files and logs
# ---------------------------------------------------------------------------
# source: (file prefix, grid number, suffix)
INIT_SOURCES = {"gfs": ("gfsanl", "3", ".grb"), "nam": ("namanl", "218", ".grb")}
SUCCESS_TEXT = "Successful completion"
