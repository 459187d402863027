"""Parameters that fit the analyses to the driver tables (FIXTURES.md section 3).

The reference's own literals ("Women Clothing", /jeans/i, Black dresses ...)
name values the driver tables do not contain; these stand in for them. The
Spark registry and the DuckDB oracle both read them from here.
"""

# Fixture parameters per analysis (FIXTURES.md section 3).
T1_CATEGORY = "BUILDING"
T1_BADGE = "Expert"
T2_MAX_PRICE = 50000
T2_MIN_LISTED = 50
T2_MIN_SOLD = 25
T5_COUNTRIES = ("NATION_3", "NATION_12", "NATION_19")
T5_MIN_PASS_RATE = 65
J1_GENDER = "Women"
J1_PATTERN = "(?i)RED"
J1_MAX_PRICE = 50000
J4_SEPARATOR = " "
J5_GENDER = "Women"
J5_KINDS = ("ring", "bolt")
J5_LABELS = ("Ring", "Bolt")
J5_COLOR = "red"
