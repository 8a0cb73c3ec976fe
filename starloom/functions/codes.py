"""Enumerated codes of the arrivals data and their labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Arrival mode.
ARRIVAL_MODES = {1: "Air", 2: "Sea", 3: "Land", 9: "Not reported"}

# Visa category.
VISA_CATEGORIES = {1: "Business", 2: "Pleasure", 3: "Student"}

# State of the address, spelt as in the source listing.
STATES = {
    "AL": "ALABAMA", "AK": "ALASKA", "AZ": "ARIZONA", "AR": "ARKANSAS", "CA": "CALIFORNIA",
    "CO": "COLORADO", "CT": "CONNECTICUT", "DE": "DELAWARE", "DC": "DIST. OF COLUMBIA",
    "FL": "FLORIDA", "GA": "GEORGIA", "GU": "GUAM", "HI": "HAWAII", "ID": "IDAHO",
    "IL": "ILLINOIS", "IN": "INDIANA", "IA": "IOWA", "KS": "KANSAS", "KY": "KENTUCKY",
    "LA": "LOUISIANA", "ME": "MAINE", "MD": "MARYLAND", "MA": "MASSACHUSETTS",
    "MI": "MICHIGAN", "MN": "MINNESOTA", "MS": "MISSISSIPPI", "MO": "MISSOURI",
    "MT": "MONTANA", "NC": "N. CAROLINA", "ND": "N. DAKOTA", "NE": "NEBRASKA", "NV": "NEVADA",
    "NH": "NEW HAMPSHIRE", "NJ": "NEW JERSEY", "NM": "NEW MEXICO", "NY": "NEW YORK",
    "OH": "OHIO", "OK": "OKLAHOMA", "OR": "OREGON", "PA": "PENNSYLVANIA", "PR": "PUERTO RICO",
    "RI": "RHODE ISLAND", "SC": "S. CAROLINA", "SD": "S. DAKOTA", "TN": "TENNESSEE",
    "TX": "TEXAS", "UT": "UTAH", "VT": "VERMONT", "VI": "VIRGIN ISLANDS", "VA": "VIRGINIA",
    "WV": "W. VIRGINIA", "WA": "WASHINGTON", "WI": "WISCONSON", "WY": "WYOMING",
    "99": "All Other Codes",
}


def code_label(code: Column, labels: dict, default: str | None = None) -> Column:
    """Label of a code through a literal map; `default` for a code that is not listed."""
    pairs = [F.lit(x) for item in labels.items() for x in item]
    label = F.try_element_at(F.create_map(*pairs), code)
    return label if default is None else F.coalesce(label, F.lit(default))


def state_code(code: Column) -> Column:
    """The code itself where it is a listed state, else '99'."""
    known = F.array(*[F.lit(c) for c in STATES])
    return F.when(F.array_contains(known, code), code).otherwise(F.lit("99"))
