"""Native Column expressions (no Python UDFs): cleaning rules, parsers, calendar, rounding, labels."""
