"""Tables in and out: text CSV, staged tables, generated loans."""
