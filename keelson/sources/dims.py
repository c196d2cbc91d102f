"""The two lookup tables of the cleaning rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Navigation status codes and their descriptions.
NAVIGATION_STATUSES = [
    (-1, "Undefined"),
    (-1, "Power-driven vessel pushing ahead or towing alongside"),
    (-1, "Power-driven vessel towing astern"),
    (0, "Under way using engine"),
    (1, "At anchor"),
    (2, "Not under command"),
    (3, "Restricted maneuverability"),
    (4, "Constrained by her draught"),
    (5, "Moored"),
    (6, "Aground"),
    (7, "Engaged in Fishing"),
    (8, "Under way sailing"),
    (9, "Reserved for future use (9)"),
    (10, "Reserved for future use (10)"),
    (11, "Reserved for future use (11)"),
    (12, "Reserved for future use (12)"),
    (13, "Reserved for future use (13)"),
    (14, "AIS-SART (active); MOB-AIS; EPIRB-AIS"),
    (15, "Not defined (default)"),
]

# Vessel type codes in code order with their group. A code may be a range
# written as text; such an entry equals no single code and so never matches one.
VESSEL_TYPES = [
    ("-1", "Null"),
    ("0", "Not Available"),
    ("1 to 19", "Other"),
    ("20", "Other"),
    ("21", "Tug Tow"),
    ("22", "Tug Tow"),
    *[(str(code), "Other") for code in range(23, 30)],
    ("30", "Fishing"),
    ("31", "Tug Tow"),
    ("32", "Tug Tow"),
    ("33", "Other"),
    ("34", "Other"),
    ("35", "Military"),
    ("36", "Pleasure Craft/Sailing"),
    ("37", "Pleasure Craft/Sailing"),
    *[(str(code), "Other") for code in range(38, 52)],
    ("52", "Tug Tow"),
    *[(str(code), "Other") for code in range(53, 60)],
    *[(str(code), "Passenger") for code in range(60, 70)],
    *[(str(code), "Cargo") for code in range(70, 80)],
    *[(str(code), "Tanker") for code in range(80, 90)],
    *[(str(code), "Other") for code in range(90, 100)],
    ("100 to 199", "Other"),
    ("200 to 255", "Other"),
    ("256 to 999", "Other"),
    ("1001", "Fishing"),
    ("1002", "Fishing"),
    ("1003", "Cargo"),
    ("1004", "Cargo"),
    *[(str(code), "Other") for code in range(1005, 1012)],
    *[(str(code), "Passenger") for code in range(1012, 1016)],
    ("1016", "Cargo"),
    ("1017", "Tanker"),
    ("1018", "Other"),
    ("1019", "Pleasure Craft/Sailing"),
    ("1020", "Other"),
    ("1021", "Military"),
    ("1022", "Other"),
    ("1023", "Tug Tow"),
    ("1024", "Tanker"),
    ("1025", "Tug Tow"),
]


def group_text(group: str) -> str:
    """A vessel group as the cleaned table spells it."""
    return group.lower().replace("/", " or ")


def status_codes(names) -> list[int]:
    """The codes whose lower-cased description is in ``names``."""
    by_name = {text.lower(): code for code, text in NAVIGATION_STATUSES}
    return sorted({by_name[name] for name in names})


def _inline_table(spark: SparkSession, rows, columns: str) -> DataFrame:
    """A table of literals, folded into the plan rather than read through Python."""
    values = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def status_dim(spark: SparkSession) -> DataFrame:
    """(status_text lower case, status_code): 19 rows."""
    return _inline_table(spark, [(text.lower(), code) for code, text in NAVIGATION_STATUSES], "status_text, status_code")


def vessel_dim(spark: SparkSession) -> DataFrame:
    """(type_text, vessel_group): one row per listed code."""
    return _inline_table(spark, [(code, group_text(group)) for code, group in VESSEL_TYPES], "type_text, vessel_group")
