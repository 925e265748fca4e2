"""Fixed values.

Every constant in this module is part of the result contract: the names,
patterns and numbers below decide what the report tables contain, so they are
stated literally and in one place.
"""

# --- keys and time -------------------------------------------------------
SNAPSHOT = "SNAPSHOT_DATE"
SYNTHETIC = "IS_SYNTHETIC"
STORY_KEY = "STORY_NUMBER"
EPIC_KEY = "EPIC_KEY"
GROUP = "PROGRAM_INCREMENT"
SPRINT_GROUP = [SNAPSHOT, GROUP]

RECENT_DAYS = 30
LOOKBACK_WEEKS = 4
MONDAY = 0
MIN_RETENTION = 0.98
# Rows of a report over a store that are joined and written at a time, in whole dates.
ROWS_AT_A_TIME = 50_000_000
NULL_RATE_WARNING = 0.10
DISPLAY_ROWS = 100
SAMPLE_ROWS = 10

# --- sprint text ---------------------------------------------------------
SPRINT_AT_END = r"(\d{2,4}\.\d+\.(?:\d+|IP))\s*$"
SPRINT_ANYWHERE = r"(\d{2}\.\d.\w+)"
IP_LABEL = "IP"
IP_RANK = 99
INCREMENT_PREFIX = 4

# --- item kinds, leaf to root --------------------------------------------
EPIC = "Epic"
FEATURE = "Feature"
SUB_CAPABILITY = "Sub-Capability"
CUSTOMER_CAPABILITY = "Customer Capability"
CUSTOMER_EPIC = "Customer Epic"
DONE = "Done"

# --- output columns ------------------------------------------------------
# Where a source column is published under another name the pair is
# "source -> output"; the rest keep their name.
STORY_COLUMNS = [
    "ISSUE_KEY -> STORY_NUMBER",
    "PROJECT_KEY",
    "PROJECT_NAME",
    "SPRINT_NAME",
    "TEAM_NAME",
    "STORY_NAME",
    "ISSUE_TYPE -> STORY_TYPE",
    "SNAPSHOT_DATE",
    "LAST_UPDATED",
    "CREATED -> CREATE_DATE",
    "UPDATED",
    "BEGIN_DATE",
    "END_DATE",
    "SPRINT_ACTIVATE_DATE",
    "SPRINT_COMPLETE_DATE",
    "TARGET_START",
    "TARGET_END",
    "INITIAL_DATE_TO_IN_PROGRESS",
    "RESOLVED -> CLOSED_DATE",
    "STATUS",
    "RESOLUTION",
    "FIX_VERSION",
    "STORY_POINTS -> ESTIMATE",
    "PROGRAM_INCREMENT",
    "CUSTOMER_EPIC_ID",
    "CUSTOMER_EPIC",
    "CUSTOMER_CAPABILITY_ID",
    "CUSTOMER_CAPABILITY",
    "SUB_CAPABILITY_ID",
    "SUB_CAPABILITY",
    "FEATURE_ID",
    "FEATURE",
    "EPIC_ID",
    "EPIC",
]

FEATURE_LOOKUP_COLUMNS = [
    "OPEN_ESTIMATE -> FEATURE_OPEN_POINTS",
    "ESTIMATE -> FEATURE_TOTAL_POINTS",
    "TEAM_NAME -> FEATURE_TEAM",
    "ISSUE_KEY -> FEATURE_ID",
    "PROGRAM_INCREMENT -> FEATURE_PI",
    "FIX_VERSION -> FEATURE_FIX_VERSION",
    "STATUS -> FEATURE_STATUS",
    "SNAPSHOT_DATE",
    "TARGET_START",
    "TARGET_END",
    "LAST_UPDATED -> IMET_SUMMARY_LAST_UPDATED",
    "PROGRAM_PRIORITY -> BV",
    "SWAG",
    "RESOLVED -> ACTUAL_END_DATE",
]

# Columns each hierarchy level contributes: "source -> output".
LEVEL_COLUMNS = {
    EPIC: [
        "ISSUE_KEY -> EPIC_KEY",
        "SUMMARY -> EPIC_SUMMARY",
        "ESTIMATE -> EPIC_ESTIMATE",
        "OPEN_ESTIMATE -> EPIC_OPEN_ESTIMATE",
    ],
    FEATURE: [
        "ISSUE_KEY -> FEATURE_KEY",
        "SUMMARY -> FEATURE_SUMMARY",
        "ESTIMATE -> FEATURE_ESTIMATE",
        "OPEN_ESTIMATE -> FEATURE_OPEN_ESTIMATE",
        "SWAG -> FEATURE_SWAG",
        "PROGRAM_PRIORITY -> BV",
        "FIX_VERSION -> FEATURE_FIX_VERSION",
    ],
    SUB_CAPABILITY: ["ISSUE_KEY -> SUBCAPABILITY_KEY"],
    CUSTOMER_CAPABILITY: ["ISSUE_KEY -> CUSTCAP_KEY"],
    CUSTOMER_EPIC: [
        "ISSUE_KEY -> CUSTEPIC_KEY",
        "SUMMARY -> PROGRAM",
        "ESTIMATE -> CUSTCAP_ESTIMATE",
    ],
}

FLAT_COLUMNS = [
    "PROGRAM",
    "CUSTEPIC_KEY",
    "CUSTCAP_ESTIMATE",
    "CUSTCAP_KEY",
    "SUBCAPABILITY_KEY",
    "FEATURE_KEY",
    "FEATURE_SUMMARY",
    "FEATURE_ESTIMATE",
    "FEATURE_OPEN_ESTIMATE",
    "FEATURE_SWAG",
    "BV",
    "FEATURE_FIX_VERSION",
    "EPIC_SUMMARY",
    "EPIC_ESTIMATE",
    "EPIC_OPEN_ESTIMATE",
]

# --- column types by name: "datetime", "float" or "string" ---------------
# Our own choice for the published columns; names absent from a table are
# skipped, and dates that must stay dates (snapshot, begin, end, targets) are
# not listed.
STORY_TYPES = {
    **dict.fromkeys(
        ["STORY_NUMBER", "PROJECT_KEY", "PROJECT_NAME", "SPRINT_NAME", "TEAM_NAME",
         "STORY_NAME", "STORY_TYPE", "STATUS", "RESOLUTION", "FIX_VERSION",
         "PROGRAM_INCREMENT", "CUSTOMER_EPIC_ID", "CUSTOMER_EPIC",
         "CUSTOMER_CAPABILITY_ID", "CUSTOMER_CAPABILITY", "SUB_CAPABILITY_ID",
         "SUB_CAPABILITY", "FEATURE_ID", "FEATURE", "EPIC_ID", "EPIC",
         "FEATURE_TEAM", "FEATURE_PI", "FEATURE_FIX_VERSION", "FEATURE_STATUS", "BV"],
        "string"),
    **dict.fromkeys(
        ["LAST_UPDATED", "CREATE_DATE", "UPDATED", "SPRINT_ACTIVATE_DATE",
         "SPRINT_COMPLETE_DATE", "INITIAL_DATE_TO_IN_PROGRESS", "CLOSED_DATE",
         "IMET_SUMMARY_LAST_UPDATED", "ACTUAL_END_DATE"],
        "datetime"),
    **dict.fromkeys(
        ["ESTIMATE", "FEATURE_OPEN_POINTS", "FEATURE_TOTAL_POINTS", "SWAG"],
        "float"),
}

EPIC_TYPES = {
    **dict.fromkeys(
        ["PROGRAM", "CUSTEPIC_KEY", "CUSTCAP_KEY", "SUBCAPABILITY_KEY", "FEATURE_KEY",
         "FEATURE_SUMMARY", "BV", "FEATURE_FIX_VERSION", "EPIC_KEY", "EPIC_SUMMARY"],
        "string"),
    **dict.fromkeys(
        ["CUSTCAP_ESTIMATE", "FEATURE_ESTIMATE", "FEATURE_OPEN_ESTIMATE",
         "FEATURE_SWAG", "EPIC_ESTIMATE", "EPIC_OPEN_ESTIMATE"],
        "float"),
}
