"""Names, patterns and constants that decide results."""

# Regions as (lat min, lat max, lon min, lon max), both ends included.
REGIONS = {
    "GrIS": (55.0, 90.0, -80.0, -10.0),
    "AIS": (-90.0, -60.0, -180.0, 180.0),
}

# Surface energy balance: Stefan-Boltzmann constant, heat capacity of ice,
# layer mass per area (400 kg m-3 over 0.08 m), step in seconds, latent heat
# of fusion, melting point.
STEFAN_BOLTZMANN = 5.67e-8
ICE_HEAT_CAPACITY = 2097.0
LAYER_MASS = 400 * 0.08
STEP_SECONDS = 3600
LATENT_HEAT = 333500.0
MELTING_POINT = 273.15

# Equal-area grid: cell size and upper-left corner in metres.
EASE_CELL = 36032.22
EASE_LEFT = -17367530.45
EASE_TOP = 7314540.83

# Dates in file names; group 1 is yyyyMMdd.
DATE_BEFORE_NC = r"\.(\d{8})\.nc$"
DATE_AFTER_SM_P = r"_SM_P_(\d{8})_"

# Satellite and confidence codes.
SATELLITES = {"A": "Aqua", "T": "Terra", "1": "NOAA-20", "N": "SUOMI-NPP"}
CONFIDENCE = {"n": "nominal", "h": "high", "l": "low"}

# Daily detection files by instrument: year and three-digit day of year.
DAILY_FILES = {
    "MODIS": "MODIS_C6_1_Global_MCD14DL_NRT_%d%03d.txt",
    "SUOMI-NPP-VIIRS": "SUOMI_VIIRS_C2_Global_VNP14IMGTDL_NRT_%d%03d.txt",
    "NOAA-20-VIIRS": "J1_VIIRS_C2_Global_VJ114IMGTDL_NRT_%d%03d.txt",
}

# Soil-moisture variables.
SOIL_VARIABLES = (
    "albedo",
    "bulk_density",
    "clay_fraction",
    "freeze_thaw_fraction",
    "grid_surface_status",
    "radar_water_body_fraction",
    "retrieval_qual_flag",
    "roughness_coefficient",
    "soil_moisture",
    "soil_moisture_error",
    "static_water_body_fraction",
    "surface_flag",
    "surface_temperature",
)

# Reanalysis variables by product.
RADIATION = ("ALBEDO", "LWGAB", "LWGEM", "LWGNT", "SWGDN", "SWGNT", "TS")
PRECIPITATION = ("PRECCU", "PRECLS", "PRECSN")
FLUXES = ("EVAP", "HFLUX", "EFLUX", "GHTSKIN")
NEAR_SURFACE = ("PS", "T2M", "U2M", "V2M", "QV2M")

# Dataset attributes that hold the extent, in the order of its columns.
EXTENT_ATTRS = (
    "SouthernmostLatitude",
    "NorthernmostLatitude",
    "WesternmostLongitude",
    "EasternmostLongitude",
    "RangeBeginningDate",
    "RangeEndingDate",
)

# Attributes of the melt variable.
MELT_ATTRS = {
    "long_name": "meltwater_production",
    "units": "kg m-2 s-1",
    "fmissing_value": 1.0e15,
    "standard_name": "meltwater",
    "vmax": 1.0e15,
    "vmin": -1.0e15,
    "fullnamepath": "/SMELT",
}
