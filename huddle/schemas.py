"""Declared schemas of the source entities and the geo box file (all nullable)."""

from pyspark.sql import types as T

TEAMS = T.StructType([
    T.StructField("team_id", T.StringType()),
    T.StructField("group_activity", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

MEMBERSHIPS = T.StructType([
    T.StructField("membership_id", T.StringType()),
    T.StructField("group_id", T.StringType()),
    T.StructField("role_title", T.StringType()),
    T.StructField("joined_at", T.TimestampType()),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("team_id", T.StringType()),
    T.StructField("event_start", T.TimestampType()),
    T.StructField("event_end", T.TimestampType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("created_at", T.TimestampType()),
])

EVENT_RSVPS = T.StructType([
    T.StructField("event_rsvp_id", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("membership_id", T.StringType()),
    T.StructField("rsvp_status", T.IntegerType()),
    T.StructField("responded_at", T.TimestampType()),
])

GEO_BOXES = T.StructType([
    T.StructField("country_code", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("min_lat", T.DoubleType()),
    T.StructField("min_lng", T.DoubleType()),
    T.StructField("max_lat", T.DoubleType()),
    T.StructField("max_lng", T.DoubleType()),
])

# entity -> (schema, primary key, timestamp that gives p_date, raw table name)
ENTITIES = {
    "teams": (TEAMS, "team_id", "created_at", "raw_teams"),
    "memberships": (MEMBERSHIPS, "membership_id", "joined_at", "raw_membership"),
    "events": (EVENTS, "event_id", "created_at", "raw_events"),
    "event_rsvps": (EVENT_RSVPS, "event_rsvp_id", "responded_at", "raw_events_rsvps"),
}

# Column lists of the published tables.
D_TEAMS = ["team_id", "team_activity", "country_code", "created_at"]
D_MEMBERSHIP = ["membership_id", "team_id", "role_title", "joined_at"]
D_EVENTS = ["event_id", "team_id", "event_start", "event_end", "event_duration_minutes",
            "has_location", "latitude", "longitude", "created_at"]
F_EVENTS_RSVPS = ["event_rsvp_id", "event_id", "membership_id", "rsvp_status",
                  "responded_at", "is_latest_response", "p_date"]
F_EVENTS_ENRICHED = ["event_id", "team_id", "event_start", "event_end", "event_date",
                     "event_duration_minutes", "team_activity", "country_code", "region",
                     "total_rsvps", "accepted_rsvps", "declined_rsvps", "unanswered_rsvps",
                     "responded_members", "event_attendance_rate"]

_CHECKED = "is_valid_record boolean, validation_error string"
_AUDIT = "etl_created_date timestamp, etl_updated_date timestamp"
_EVENT = ("event_id string, team_id string, event_start timestamp, event_end timestamp, latitude double, "
          "longitude double, created_at timestamp, has_location boolean, event_duration_minutes double")
_RSVP = ("event_rsvp_id string, event_id string, membership_id string, rsvp_status int, responded_at timestamp, "
         "is_latest_response boolean")

# Stored tables as DDL, for reading one that has no file yet.
STORED = {
    **{table: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields) + ", p_date date"
       for schema, _, _, table in ENTITIES.values()},
    "clean_teams": "team_id string, team_activity string, country_code string, created_at timestamp, "
                   f"is_valid_country_code boolean, {_CHECKED}, p_date date",
    "clean_membership": "membership_id string, team_id string, role_title string, joined_at timestamp, "
                        f"is_valid_team_id boolean, {_CHECKED}, p_date date",
    "clean_events": f"{_EVENT}, is_valid_team_id boolean, is_valid_timestamps boolean, {_CHECKED}, p_date date",
    "clean_events_rsvps": f"{_RSVP}, rsvp_response string, is_valid_event_id boolean, is_valid_membership_id boolean, "
                          f"is_valid_rsvp boolean, {_CHECKED}, p_date date",
    "team_ids": "team_id string, id bigint",
    "team_days": "page bigint, teams binary, events bigint, total_rsvps bigint, accepted_rsvps bigint, event_date date",
    "partition_histograms": "table_name string, column_name string, value string, n bigint, p_date date",
    **{f"changes_{t}": "key string, p_date date" for t in ("clean_teams", "clean_membership", "clean_events", "clean_events_rsvps")},
    "d_teams": f"team_id string, team_activity string, country_code string, created_at timestamp, {_AUDIT}",
    "d_membership": f"membership_id string, team_id string, role_title string, joined_at timestamp, {_AUDIT}",
    "d_events": f"{_EVENT}, {_AUDIT}",
    "d_geo_looker": "country_code string, state string, min_lat double, min_lng double, max_lat double, max_lng double",
    "f_events_rsvps": f"{_RSVP}, etl_created_date timestamp, p_date date",
    "f_events_enriched": "event_id string, team_id string, event_start timestamp, event_end timestamp, "
                         "event_duration_minutes double, team_activity string, country_code string, region string, "
                         "total_rsvps bigint, accepted_rsvps bigint, declined_rsvps bigint, unanswered_rsvps bigint, "
                         "responded_members bigint, event_attendance_rate decimal(27,2), etl_created_date timestamp, "
                         "event_date date",
}
