"""Names, patterns, texts and defaults that inputs and outputs must carry exactly."""

# Columns every control table must have.
CONTROL_COLUMNS = (
    "inbound_location",
    "preprocess_location",
    "file_prefix",
    "delimiter",
    "expected_column_list",
    "target_table_name",
)

# File name per feed type; matched from the start of the name, ignoring case.
FILE_PATTERNS = {
    "event": r"LMHC_EVENT_\d{14}\.csv$",
    "participant": r"LMHC_PARTICIPANT_\d{14}\.csv$",
    "event_del": r"LMHC_EVENT_DEL_\d{14}\.csv$",
    "hcp_master": r"LMHC_hcp_master_file_\d{8}\.csv$",
    "address": r"LMHC_address_file_\d{8}\.csv$",
    "child_attributes": r"LMHC_child_attributes_\d{8}\.csv$",
}

# Declared key and required columns per feed type.
KEYS = {
    "event": ("event_id",),
    "event_del": ("event_id",),
    "participant": ("participant_id", "event_id"),
    "hcp_master": ("hcp_id",),
    "address": ("address_id",),
    "child_attributes": ("attribute_id",),
    "expenses": ("event_vendor_id",),
}
REQUIRED = {
    "event": ("event_id", "event_date"),
    "event_del": ("event_id", "deletion_date"),
    "participant": ("participant_id", "event_id", "hcp_id"),
    "hcp_master": ("hcp_id", "hcp_name"),
    "address": ("address_id", "hcp_id", "address_line1", "city", "state", "zip"),
    "child_attributes": ("attribute_id", "hcp_id", "attribute_name", "attribute_value"),
    "expenses": ("event_vendor_id",),
}

# Audit columns.
INTAKE_TIME = "processing_timestamp"
CREATED = "oasis_create_date"
MODIFIED = "oasis_modified_date"
LOADED = "oasis_load_time"
ERROR_REASON = "error_reason"
ERROR_TIME = "error_timestamp"
DUPLICATE_FLAG = "is_duplicate"
PROCESSING_DATE = "processing_date"

# Row reject reasons.
REASON_DUPLICATE = "Duplicate key violation"
REASON_NULL = "Null value in key column"
REASON_MISSING_CHILD = (
    "Referential integrity issue - missing in address or child_attributes"
)
REASON_MISSING_PARENT = "Referential integrity issue - HCP not found in master"

# Brand and indication lookup.
BRAND_SEPARATOR = "|"
DEFAULT_BRAND_ID = "412"
DEFAULT_BRAND_NAME = "UNKNOWN"

# Columns of the normalized tables, in output order.
EVENT_COLUMNS = (
    "event_id", "event_name", "event_date", "event_type", "event_vendor_id",
    "event_brand", "brand_id", "brand_name", "indication_name", "indication_id",
    "event_location", "source_system", "source_file_name", "source_file_date",
    "oasis_create_date", "oasis_modified_date", "oasis_load_time",
)
PARTICIPANT_COLUMNS = (
    "participant_id", "event_id", "hcp_id", "participant_type", "participation_status",
    "registered", "attended", "mdm_id", "final_mdm_id",
    "oasis_create_date", "oasis_modified_date", "oasis_load_time",
)
EXPENSE_COLUMNS = (
    "event_id", "event_vendor_id", "event_expense",
    "event_expense_estimate", "event_expense_actual",
)

# File names of the master data.
PRODUCT_MASTER = "product_master.csv"
INDICATION_MASTER = "indication_master.csv"
XREF_MASTER = "master_xref.csv"
MERGE_MASTER = "master_mdm_merge.csv"

# Export.
EXPORT_SEPARATOR = "|"
EXPORT_MODIFIED_COLUMNS = ("oasis_modified_date", "modified_date")

# Column types and value domains of the feed contract.
CONTRACT_TYPES = {
    "event_start_date": "date",
    "event_end_date": "date",
    "planned_customers": "int",
    "total_attendees": "int",
    "speakers_attended": "int",
    "employees_and_partners_attended": "int",
    "vendors_attended": "int",
    "customers_attended": "int",
    "patients_attended": "int",
    "customers_rsvp": "int",
    "patients_rsvp": "int",
    "customers_invited_email": "int",
    "patients_invited_email": "int",
    "room_capacity": "int",
    "guaranteed_headcount": "int",
    "receipt_count": "int",
    "contract_food_and_bev_min_rsvp": "int",
    "minimum_rsvp": "int",
    "estimate": "double",
    "actual": "double",
    "participant_expense_actual": "double",
    "participant_expense_estimate": "double",
}
CONTRACT_DOMAINS = {
    "event_status": (
        "Pending", "Confirmed", "Occurred", "Closed", "Dropped", "Canceled",
        "Canceled Closed", "On Hold",
    ),
    "event_type": ("Program", "Product Theater", "GPO", "National Broadcast", "Training"),
    "event_sub_type": ("HCP", "Patient", "Training"),
    "event_format": (
        "In-Person", "Hybrid", "Virtual", "Abbreviated Hybrid", "Abbreviated Virtual",
        "Child", "Broadcast to Multi-site", "Abbreviated Multi-site",
        "In-Person Multi-site",
    ),
    "meal_type": ("Breakfast", "Lunch", "Dinner", "Light Refreshment", "No Meal Provided"),
    "overall_sign_in_sheet_status": (
        "Missing", "Received", "Approved", "Problem", "Good", "Uncorrectable", "Partial",
        "Not Required",
    ),
    "paper_sign_in_sheet_status": (
        "Missing", "Received", "Approved", "Problem", "Good", "Uncorrectable", "Partial",
        "Not Required",
    ),
}
# A child event must name its parent.
CHILD_EVENT_RULE = ("is_child_event", "Yes", "parent_event_vendor_id")
# Each customer must have at least one attribute row of one of these categories.
REQUIRED_CATEGORIES = ("Profession", "Credential", "Degree", "Identifier")
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
