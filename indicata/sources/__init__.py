"""Typed readers for landed files."""

from indicata.sources.archives import (ZipCatalogue, archive_stems, header_columns, member_layouts, member_table,
                                       read_zip_headers, read_zip_members, read_zip_preamble)
from indicata.sources.csv import read_csv_text, read_csv_typed
from indicata.sources.faults import fault_report, raise_faults, set_aside
from indicata.sources.json import json_records_checked, json_texts, read_json_records, read_json_series
from indicata.sources.memory import rows_to_frame
from indicata.sources.preamble import (PREAMBLE_LINES, folder_stems, indicator_values, preamble_lines,
                                       preamble_records, read_indicator_folder, read_preamble_lines)

__all__ = [
    "PREAMBLE_LINES", "ZipCatalogue", "archive_stems", "fault_report", "folder_stems", "header_columns", "indicator_values", "json_records_checked", "json_texts",
    "member_layouts", "member_table",
    "preamble_lines", "preamble_records", "read_zip_headers", "read_zip_preamble", "read_csv_text",
    "read_csv_typed", "read_indicator_folder", "read_json_records", "read_json_series",
    "read_preamble_lines", "read_zip_members", "raise_faults", "rows_to_frame", "set_aside",
]
