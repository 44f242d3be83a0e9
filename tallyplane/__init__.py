"""tallyplane: a PySpark engine for declared-grid measurement tables."""
