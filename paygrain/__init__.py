"""paygrain: a PySpark library for batch dimensional warehousing of payroll-style data."""
