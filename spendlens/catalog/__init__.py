"""The registered queries: driver tables mapped to the logical tables, and SQL to check them by."""
