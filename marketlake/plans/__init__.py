"""The data flows: normalised tables, star schema, loads and reports."""
