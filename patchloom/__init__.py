"""Part of patchloom, a PySpark library for patch, test-log and score analytics."""
