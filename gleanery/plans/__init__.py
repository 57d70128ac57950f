"""End-to-end jobs, their bookkeeping tables and reports."""
