"""Outputs: CSV directories, JDBC tables, first-n reports."""

from indicata.sinks.files import as_text_table, csv_roundtrip, write_csv
from indicata.sinks.jdbc import write_jdbc
from indicata.sinks.preview import first_n

__all__ = ["as_text_table", "csv_roundtrip", "first_n", "write_csv", "write_jdbc"]
