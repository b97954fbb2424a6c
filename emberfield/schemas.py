"""Explicit schemas of the files and tables the library reads; nothing is inferred."""

from __future__ import annotations

# Column lists are DDL strings, accepted by every Spark reader.
FIRE = (
    "incident_id BIGINT, original_latitude DOUBLE, original_longitude DOUBLE, confidence_score INT, "
    "source_system STRING, datetime_record TIMESTAMP_NTZ"
)
WEATHER = (
    "weather_id BIGINT, original_latitude DOUBLE, original_longitude DOUBLE, temperature_c DOUBLE, "
    "wind_speed_kmh DOUBLE, relative_humidity DOUBLE, source_system STRING, datetime_record TIMESTAMP_NTZ"
)
VEGETATION = (
    "veg_condition_id BIGINT, original_latitude DOUBLE, original_longitude DOUBLE, dryness_index DOUBLE, "
    "soil_moisture DOUBLE, vegetation_class STRING, source_system STRING, datetime_record TIMESTAMP_NTZ"
)
TOPOGRAPHY = "topo_id BIGINT, original_latitude DOUBLE, original_longitude DOUBLE, elevation_m DOUBLE, slope_angle DOUBLE"
INFRASTRUCTURE = (
    "asset_id BIGINT, original_latitude DOUBLE, original_longitude DOUBLE, facility_name STRING, risk_category STRING"
)
HOTSPOTS = (
    "latitude DOUBLE, longitude DOUBLE, bright_ti4 DOUBLE, scan DOUBLE, track DOUBLE, acq_date DATE, acq_time STRING, "
    "satellite STRING, instrument STRING, confidence STRING, version STRING, bright_ti5 DOUBLE, frp DOUBLE, "
    "daynight STRING"
)
ARCHIVE = (
    "latitude DOUBLE, longitude DOUBLE, brightness DOUBLE, scan DOUBLE, track DOUBLE, acq_date DATE, acq_time STRING, "
    "satellite STRING, instrument STRING, confidence STRING, version STRING, bright_t31 DOUBLE, frp DOUBLE, "
    "daynight STRING"
)
# Model features of the environment exports, in model order.
ENV_FEATURES = [
    "skin_temperature_c", "soil_temperature_level_1_c", "surface_solar_radiation_downwards",
    "surface_thermal_radiation_downwards", "temperature_2m_c", "u_component_of_wind_10m", "v_component_of_wind_10m",
]
ENVIRONMENT = (
    "`system:index` STRING, datetime TIMESTAMP_NTZ, grid_id STRING, interval_start STRING, "
    + ", ".join(f"{f} DOUBLE" for f in ENV_FEATURES) + ", `.geo` STRING"
)
FIRE_LABELS = "datetime TIMESTAMP_NTZ, daynight INT, is_burning INT, geometry STRING"
REGISTRY = "location_id BIGINT, grid_latitude DOUBLE, grid_longitude DOUBLE, region_name STRING"
INCIDENT_FEATURES = (
    "type STRING, features ARRAY<STRUCT<type: STRING, geometry: STRING, properties: STRUCT<"
    "id: STRING, feedType: STRING, category1: STRING, category2: STRING, status: STRING, name: STRING, "
    "action: STRING, location: STRING, created: STRING, updated: STRING, sizeFmt: STRING, sourceOrg: STRING, "
    "sourceTitle: STRING>>>"
)
HOURLY = (
    "latitude DOUBLE, longitude DOUBLE, hourly STRUCT<time: ARRAY<STRING>, temperature_2m: ARRAY<DOUBLE>, "
    "relative_humidity_2m: ARRAY<DOUBLE>, wind_speed_10m: ARRAY<DOUBLE>>"
)
GRID_ARRAYS = (
    "cell_lat ARRAY<DOUBLE>, cell_lon ARRAY<DOUBLE>, sm_surface ARRAY<DOUBLE>, sm_rootzone ARRAY<DOUBLE>"
)
RISK_COLLECTION = (
    "type STRING, features ARRAY<STRUCT<type: STRING, geometry: STRUCT<type: STRING, "
    "coordinates: ARRAY<ARRAY<ARRAY<DOUBLE>>>>, properties: STRUCT<risk_factor: INT>>>"
)
RUN_LOG = (
    "run_id STRING, pipeline_name STRING, sources_attempted STRING, sources_succeeded STRING, status STRING, "
    "started_at TIMESTAMP_NTZ, finished_at TIMESTAMP_NTZ, rows_fetched BIGINT, rows_inserted BIGINT, "
    "rows_skipped BIGINT, error_message STRING"
)
