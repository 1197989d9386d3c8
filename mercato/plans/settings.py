"""Parameter values of the registered query variants (test mapping).

Fixed values: a seller state present at every test scale, and a date range
inside the test data's span.
"""

STATE = "NATION_3"
START = "1996-01-01"
END = "1999-12-31"
NOW = "2026-01-01 00:00:00"  # "now" of the date-range check in registered queries
