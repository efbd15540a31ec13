"""End-to-end pipelines and the driver-table queries."""
