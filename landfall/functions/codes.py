"""Fixed values of the admission data dictionary and of the source files."""

from __future__ import annotations

# Destination state codes and labels, spelled as the dictionary spells them.
STATE_LABELS = [
    ("AL", "ALABAMA"),
    ("AK", "ALASKA"),
    ("AZ", "ARIZONA"),
    ("AR", "ARKANSAS"),
    ("CA", "CALIFORNIA"),
    ("CO", "COLORADO"),
    ("CT", "CONNECTICUT"),
    ("DE", "DELAWARE"),
    ("DC", "DIST. OF COLUMBIA"),
    ("FL", "FLORIDA"),
    ("GA", "GEORGIA"),
    ("GU", "GUAM"),
    ("HI", "HAWAII"),
    ("ID", "IDAHO"),
    ("IL", "ILLINOIS"),
    ("IN", "INDIANA"),
    ("IA", "IOWA"),
    ("KS", "KANSAS"),
    ("KY", "KENTUCKY"),
    ("LA", "LOUISIANA"),
    ("ME", "MAINE"),
    ("MD", "MARYLAND"),
    ("MA", "MASSACHUSETTS"),
    ("MI", "MICHIGAN"),
    ("MN", "MINNESOTA"),
    ("MS", "MISSISSIPPI"),
    ("MO", "MISSOURI"),
    ("MT", "MONTANA"),
    ("NC", "N. CAROLINA"),
    ("ND", "N. DAKOTA"),
    ("NE", "NEBRASKA"),
    ("NV", "NEVADA"),
    ("NH", "NEW HAMPSHIRE"),
    ("NJ", "NEW JERSEY"),
    ("NM", "NEW MEXICO"),
    ("NY", "NEW YORK"),
    ("OH", "OHIO"),
    ("OK", "OKLAHOMA"),
    ("OR", "OREGON"),
    ("PA", "PENNSYLVANIA"),
    ("PR", "PUERTO RICO"),
    ("RI", "RHODE ISLAND"),
    ("SC", "S. CAROLINA"),
    ("SD", "S. DAKOTA"),
    ("TN", "TENNESSEE"),
    ("TX", "TEXAS"),
    ("UT", "UTAH"),
    ("VT", "VERMONT"),
    ("VI", "VIRGIN ISLANDS"),
    ("VA", "VIRGINIA"),
    ("WV", "W. VIRGINIA"),
    ("WA", "WASHINGTON"),
    ("WI", "WISCONSON"),
    ("WY", "WYOMING"),
    ("99", "All Other Codes"),
]
OTHER_STATE = "99"

# Usual spellings of states that the dictionary abbreviates or misspells.
STATE_ALIASES = [
    ("DISTRICT OF COLUMBIA", "DC"),
    ("NORTH CAROLINA", "NC"),
    ("NORTH DAKOTA", "ND"),
    ("SOUTH CAROLINA", "SC"),
    ("SOUTH DAKOTA", "SD"),
    ("WEST VIRGINIA", "WV"),
    ("WISCONSIN", "WI"),
]

# Arrival modes.
MODE_LABELS = [("1", "Air"), ("2", "Sea"), ("3", "Land"), ("9", "Not reported")]

# Visa categories.
VISA_LABELS = [("1", "Business"), ("2", "Pleasure"), ("3", "Student")]

# Race names in the city file and their column names in the dimension.
RACE_COLUMNS = {
    "American Indian and Alaska Native": "native_american",
    "Asian": "asian",
    "Hispanic or Latino": "hispanic_or_latino",
    "Black or African-American": "black",
    "White": "white",
}
