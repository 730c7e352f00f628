"""Fixed lookup values and thresholds.

Everything in this module is a fixed value that results depend on.  Small tables
become map literals inside expressions, so looking one up needs no join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: market -> balancing authorities -------------------------------
MARKET_AUTHORITIES = {
    "nova": ["PJM"],
    "dfw": ["ERCO"],
    "phx": ["SRP", "AZPS"],
    "chi": ["PJM", "MISO"],
    "atl": ["SOCO"],
    "coh": ["PJM"],
    "sjc": ["CISO"],
    "pdx": ["BPAT"],
    "rno": ["NEVP"],
    "phl": ["PJM"],
}

# --- fixed values: market -> weather stations ------------------------------------
MARKET_STATIONS = {
    "nova": ["GHCND:USW00013743"],
    "dfw": ["GHCND:USW00003927"],
    "phx": ["GHCND:USW00023183"],
    "chi": ["GHCND:USW00094846"],
    "atl": ["GHCND:USW00013874"],
    "coh": ["GHCND:USW00014821"],
    "sjc": ["GHCND:USW00023293"],
    "pdx": ["GHCND:USW00024229"],
    "rno": ["GHCND:USW00024128"],
    "phl": ["GHCND:USW00014737"],
}

# --- fixed values: state -> primary balancing authority --------------------------
STATE_AUTHORITY = {
    "VA": "PJM", "MD": "PJM", "PA": "PJM", "OH": "PJM", "NJ": "PJM", "DE": "PJM",
    "WV": "PJM", "NC": "PJM", "IL": "PJM", "TX": "ERCO", "CA": "CISO", "GA": "SOCO",
    "OR": "BPAT", "WA": "BPAT", "NV": "NEVP", "AZ": "SRP", "CO": "PSCO", "UT": "PACE",
    "TN": "TVA", "SC": "SCEG",
}

# --- fixed values: states with the most sites -> FIPS ----------------------------
TOP_STATE_FIPS = {
    "VA": "51", "TX": "48", "CA": "06", "IL": "17", "GA": "13",
    "OH": "39", "PA": "42", "AZ": "04", "OR": "41", "NV": "32",
}

# --- fixed values: state FIPS -> postal code -------------------------------------
FIPS_STATE = {
    "01": "AL", "02": "AK", "04": "AZ", "05": "AR", "06": "CA", "08": "CO", "09": "CT",
    "10": "DE", "11": "DC", "12": "FL", "13": "GA", "15": "HI", "16": "ID", "17": "IL",
    "18": "IN", "19": "IA", "20": "KS", "21": "KY", "22": "LA", "23": "ME", "24": "MD",
    "25": "MA", "26": "MI", "27": "MN", "28": "MS", "29": "MO", "30": "MT", "31": "NE",
    "32": "NV", "33": "NH", "34": "NJ", "35": "NM", "36": "NY", "37": "NC", "38": "ND",
    "39": "OH", "40": "OK", "41": "OR", "42": "PA", "44": "RI", "45": "SC", "46": "SD",
    "47": "TN", "48": "TX", "49": "UT", "50": "VT", "51": "VA", "53": "WA", "54": "WV",
    "55": "WI", "56": "WY",
}

# --- fixed values: balancing authority -> time zone ------------------------------
AUTHORITY_ZONE = {
    "PJM": "US/Eastern", "ERCO": "US/Central", "CISO": "US/Pacific", "SOCO": "US/Eastern",
    "BPAT": "US/Pacific", "MISO": "US/Central", "NEVP": "US/Pacific", "SRP": "US/Arizona",
    "PSCO": "US/Mountain", "TVA": "US/Central",
}
DEFAULT_ZONE = "US/Eastern"

# --- fixed values: construction status synonyms ----------------------------------
STATUS_SYNONYMS = {
    "operational": "operational", "online": "operational", "active": "operational",
    "under construction": "under_construction", "construction": "under_construction",
    "building": "under_construction",
    "planned": "planned", "announced": "planned", "proposed": "planned",
    "expanding": "expanding", "expansion": "expanding",
}

# --- fixed values: owners and name fragments of AI sites (substring match) -------
AI_OWNERS = (
    "openai", "anthropic", "google", "deepmind", "meta", "microsoft", "xai", "nvidia",
    "amazon", "aws", "oracle", "coreweave", "lambda", "together", "cerebras", "inflection",
)
AI_NAME_PARTS = ("ai", "gpu", "training", "inference", "colossus", "stargate")

# --- fixed values: retail sectors, demand regions, weather measures --------------
RETAIL_SECTORS = ("RES", "COM", "IND", "ALL")
RETAIL_START = "2014-01"
TARGET_REGIONS = ("PJM", "ERCO", "CISO", "SOCO", "BPAT")
WEATHER_MEASURES = ("TAVG", "TMAX", "TMIN", "CDSD", "HDSD")

# --- fixed values: national site consumption, TWh and percent of total -----------
NATIONAL_BASELINE = [
    (2014, "all", 60.0, 1.6, False, "DOE/Berkeley Lab 2024"),
    (2015, "all", 60.0, 1.6, False, "DOE/Berkeley Lab 2024"),
    (2016, "all", 60.0, 1.6, False, "DOE/Berkeley Lab 2024"),
    (2017, "all", 75.0, 1.9, False, "DOE/Berkeley Lab 2024"),
    (2018, "all", 90.0, 2.3, False, "DOE/Berkeley Lab 2024"),
    (2019, "all", 105.0, 2.7, False, "DOE/Berkeley Lab 2024"),
    (2020, "all", 120.0, 3.1, False, "DOE/Berkeley Lab 2024"),
    (2021, "all", 135.0, 3.4, False, "DOE/Berkeley Lab 2024"),
    (2022, "all", 150.0, 3.7, False, "DOE/Berkeley Lab 2024"),
    (2023, "all", 176.0, 4.4, False, "DOE/Berkeley Lab 2024"),
    (2024, "all", 183.0, 4.0, False, "IEA 2025"),
]

# --- fixed values: unit factors --------------------------------------------------
MWH_TO_GWH = 1 / 1000
MWH_TO_TWH = 1 / 1_000_000
GWH_TO_TWH = 1 / 1000
KWH_TO_MWH = 1 / 1000
MW_TO_GW = 1 / 1000
MW_TO_ANNUAL_MWH = 8760 * 0.85

# --- fixed values: analysis thresholds -------------------------------------------
BASELINE_MONTHS = 36
MIN_POST_MONTHS = 3
ANALYSIS_WINDOW_MONTHS = 12
MIN_CONFIDENCE = 0.5
SIGNIFICANCE_LEVEL = 0.05
MIN_COMPLETENESS = 0.8
ANOMALY_PCT = 10.0
MEDIUM_PCT = 15.0
HIGH_PCT = 25.0
SMOOTHING_HOURS = 168
MAX_POPULATION_DIFF_PCT = 30
MAX_CLIMATE_ZONE_DIFF = 1
MIN_CORRELATION_MONTHS = 6
CONGESTION_ALERT = 50
PRICE_SPIKE_ALERT = 200
GROWTH_RATE = 0.02
DEFAULT_IMPACT_FACTOR = 1.3
DEFAULT_PUE = 1.3

# --- fixed values: streaming and paging settings ---------------------------------
DEMAND_WATERMARK = "15 minutes"
PRICE_WATERMARK = "5 minutes"
DEMAND_TRIGGER = "300 seconds"
PRICE_TRIGGER = "60 seconds"
DEMAND_POLL_S, DEMAND_COMMIT_S = 300, 60
PRICE_POLL_S, PRICE_COMMIT_S = 60, 30
LATENCY_TARGET_S = 15
ALERT_COOLDOWN_MINUTES = 60
MAX_ROW_BYTES = 512_000
PAGE_ROWS = 5000
INGEST_OVERLAP_HOURS = 48


def lookup(table: dict[str, str], key: Column) -> Column:
    """Value of ``key`` in a fixed table, NULL when absent (no join, no shuffle)."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), key)
