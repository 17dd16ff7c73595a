"""Fixed values of the service-request data: names, formats, lookup tables, limits. Data only, no logic."""

# --- fixed values: raw column names, in file order -------------------------------------------------------------------
RAW_COLUMNS = [
    "unique_key", "created_date", "closed_date", "agency", "agency_name", "problem", "problem_detail",
    "additional_details", "location_type", "incident_zip", "incident_address", "street_name", "cross_street_1",
    "cross_street_2", "intersection_street_1", "intersection_street_2", "address_type", "city", "landmark",
    "facility_type", "status", "due_date", "resolution_description", "resolution_action_updated_date",
    "community_board", "council_district", "police_precinct", "bbl", "borough", "x_coordinate", "y_coordinate",
    "open_data_channel_type", "park_facility_name", "park_borough", "vehicle_type", "taxi_company_borough",
    "taxi_pickup_location", "bridge_highway_name", "bridge_highway_direction", "road_ramp",
    "bridge_highway_segment", "latitude", "longitude", "location",
]

# --- fixed values: text formats --------------------------------------------------------------------------------------
TIMESTAMP_TEXT = "MM/dd/yyyy hh:mm:ss a"
DATE_KEY_TEXT = "yyyyMMdd"
NO_AREA = "UNSPECIFIED"

# --- fixed values: agency code -> agency type ------------------------------------------------------------------------
AGENCY_TYPES = {
    "Public Safety": ["NYPD", "FIRE", "DOC"],
    "Infrastructure": ["DOT", "DEP", "DSNY"],
    "Housing": ["HPD", "DOB"],
    "Consumer Affairs": ["DCA"],
    "Health": ["DOHMH"],
    "Parks": ["DPR"],
    "Transportation": ["TLC"],
}
AGENCY_TYPE_DEFAULT = "Other City Agency"

# --- fixed values: complaint type pattern -> category, the first match wins ------------------------------------------
COMPLAINT_CATEGORIES = [
    ("(?i)noise", "Noise"),
    ("(?i)heat|plumbing|paint|mold", "Housing Maintenance"),
    ("(?i)parking|traffic|bike", "Transportation"),
    ("(?i)rodent|sanit|dirty|trash", "Sanitation"),
    ("(?i)drug|assault|illegal", "Public Safety"),
    ("(?i)tree|park", "Parks"),
    ("(?i)water|sewer", "Water & Sewer"),
]
COMPLAINT_CATEGORY_DEFAULT = "Other"

# --- fixed values: month -> season -----------------------------------------------------------------------------------
SEASONS = {"Winter": [12, 1, 2], "Spring": [3, 4, 5], "Summer": [6, 7, 8]}
SEASON_DEFAULT = "Fall"

# --- fixed values: status rows (key, code, label, is_resolved, is_pending) -------------------------------------------
STATUS_ROWS = [
    (1, "CLOSED", "Closed", True, False),
    (2, "OPEN", "Open", False, True),
    (3, "PENDING", "Pending", False, True),
    (4, "IN PROGRESS", "In Progress", False, True),
    (5, "ASSIGNED", "Assigned", False, True),
    (6, "UNSPECIFIED", "Unspecified", False, False),
]

# --- fixed values: table names in a database -------------------------------------------------------------------------
DATABASE_TABLES = {
    "request_raw": "bronze.request_raw",
    "request_cleaned": "silver.request_cleaned",
    "date": "gold.date",
    "agency": "gold.agency",
    "location": "gold.location",
    "complaint": "gold.complaint",
    "status": "gold.status",
    "requests": "gold.requests",
    "aggregation_complaint_by_year": "gold.aggregation_complaint_by_year",
    "aggregation_channel_by_borough": "gold.aggregation_channel_by_borough",
}

# --- fixed values: contract limits -----------------------------------------------------------------------------------
OFFICIAL_BOROUGHS = ["MANHATTAN", "BROOKLYN", "QUEENS", "BRONX", "STATEN ISLAND"]
QUALITY_LIMITS = {
    # metric: (comparison, limit, severity)
    "row_count": (">", 0.0, "error"),
    "completeness_agency_key": (">", 98.0, "error"),
    "completeness_location_key": (">", 90.0, "warning"),
    "completeness_date_key": (">", 95.0, "warning"),
    "validity_resolution_hours": ("=", 100.0, "error"),
    "consistency_borough": ("=", 100.0, "error"),
}
REQUIRED_COLUMNS = {
    "requests": ["request_id"],
    "date": ["date_key", "full_date", "year", "month", "quarter", "day_of_week", "is_weekend", "season"],
    "agency": ["agency_key", "agency_code", "agency_name"],
    "location": ["location_key", "borough"],
    "complaint": ["complaint_key", "complaint_type"],
    "status": ["status_key", "status_code", "status_label", "is_resolved", "is_pending"],
}
PRIMARY_KEYS = {
    "requests": ["request_id"],
    "date": ["date_key"],
    "agency": ["agency_key"],
    "location": ["location_key"],
    "complaint": ["complaint_key"],
    "status": ["status_key"],
}
FOREIGN_KEYS = {
    # fact column: dimension (its key has the same name)
    "date_key": "date",
    "agency_key": "agency",
    "location_key": "location",
    "complaint_key": "complaint",
    "status_key": "status",
}
