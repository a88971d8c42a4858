"""Schemas of the input layouts, by field name; readers pick columns by position and cast to these."""

from __future__ import annotations

FLIGHT_LOG = {0: "lat double", 1: "lon double", 2: "alt_ft double", 10: "elapsed_ms bigint", 11: "local_stamp string", 37: "recording string", 43: "ts_ms bigint"}
PHOTO_LOG = {0: "lat double", 1: "lon double", 2: "alt_ft double", 12: "local_stamp string", 27: "taking_photo string"}
CAM = {1: "week_ms bigint", 2: "week int", 3: "lat double", 4: "lon double", 6: "altitude double"}
GPS = {1: "week_ms bigint", 2: "week int", 6: "lat double", 7: "lon double", 8: "altitude double"}
ROVER = {2: "utc_time string", 3: "elevation double", 4: "longitude double", 5: "long_ref string", 6: "latitude double", 7: "lat_ref string", 8: "ndvi double", 9: "temp_c double"}
TRIGGER_LOG = "cam1 string, cam2 string, cam3 string, t string"
OBSERVATION = (
    "sensor_id string, value double, x double, y double, z double, time_utc string, date string, left_utc string, left_elevation double, left_long double, left_lat double, "
    "long_zone int, lat_zone string, left_utm_x double, left_utm_y double, right_utc string, right_elevation double, right_long double, right_lat double, right_utm_x double, "
    "right_utm_y double, offset_x double, offset_y double, offset_z double"
)
IMAGE_POSITION = "plot_id string, image_file_name string, longitude double, latitude double, utm_x double, utm_y double, sampling_utc double"
IMAGE_POSITION_UTM = "camera string, image_file_name string, utm_x double, utm_y double, sampling_utc double"
WAYPOINT = "lat double, lon double"
PLOT_CORNER = "plot_id string, c1_1_lon double, c1_1_lat double, c2_1_lon double, c2_1_lat double, c2_2_lon double, c2_2_lat double, c1_2_lon double, c1_2_lat double"
POINT = "x double, y double, z double, r int, g int, b int"
PMATRIX = "image string, " + ", ".join(f"m{r}{c} double" for r in (1, 2, 3) for c in (1, 2, 3, 4))
OFFSET = "dx double, dy double, dz double"
PIXEL = "image_file string, u int, v int, r int, g int, b int"
SEGMENT_TIME = "segment_id string, start_ms bigint, duration_ms bigint"
IMAGE_SIZE = "image string, width int, height int"
CALIBRATION = "serial_number string, parameter_type string, parameter_value double"
EXPERIMENT = "record_id bigint, experiment_id string, location string, environment string, planting_date date, harvest_date date, xmin double, ymin double, xmax double, ymax double, notes string"
IMAGE_TAGS = "name string, size bigint, gps_lat string, gps_lat_ref string, gps_lon string, gps_lon_ref string, gps_alt string, gps_alt_ref string, gps_date string, gps_time string, datetime_original string, body_serial string"
#: Columns of the older image metadata files, in their order.
IMAGE_ROW_OLD = (
    "record_id", "image_file_name", "flight_id", "sensor_id", "uas_position_x", "uas_position_y", "uas_position_z", "uas_latitude", "uas_longitude", "uas_sampling_date_utc", "uas_sampling_time_utc",
    "uas_lat_zone", "uas_long_zone", "uas_altitude_reference", "cam_position_x", "cam_position_y", "cam_position_z", "cam_latitude", "cam_longitude", "cam_sampling_date_utc", "cam_sampling_time_utc",
    "cam_lat_zone", "cam_long_zone", "cam_altitude_reference", "md5sum", "notes",
)
#: Columns of the image metadata table, in the order of its files.
IMAGE_ROW = ("record_id", "image_file_name", "flight_id", "sensor_id", "date_utc", "time_utc", "position", "altitude", "altitude_ref", "gcp_world_coords", "gcp_pixel_coords", "md5sum", "position_source", "notes")
