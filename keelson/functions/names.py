"""Column naming."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# The raw message columns, the misspelt one included, and their names from here on.
NAMES = {
    "MMSI": "mmsi",
    "BaseDateTime": "base_datetime",
    "BaseDatetime": "base_datetime",
    "LAT": "lat",
    "LON": "lon",
    "SOG": "sog",
    "COG": "cog",
    "Heading": "heading",
    "VesselName": "vessel_name",
    "IMO": "imo",
    "CallSign": "call_sign",
    "VesselType": "vessel_type",
    "Status": "status",
    "Length": "length",
    "Width": "width",
    "Draft": "draft",
    "Cargo": "cargo",
    "TransceiverClass": "transceiver_class",
    "TranscieverClass": "transceiver_class",
}

#: A word of a camel-case name: capitals that no small letter follows, or one capital at most and what is not one.
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[^A-Z\W_]+")


def to_snake_case(name: str) -> str:
    """The name of a raw column; one that messages do not have is cut into its words (``IMONumber``: imo_number)."""
    return NAMES.get(name) or "_".join(word.lower() for word in _WORD.findall(name)) or name


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every raw column."""
    return df.toDF(*[to_snake_case(c) for c in df.columns])
