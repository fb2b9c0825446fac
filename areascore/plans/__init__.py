"""Table-building plans, reports and the end-to-end chain."""
