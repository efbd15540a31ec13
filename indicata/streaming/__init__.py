"""Incremental runs of the row-level pipelines over newly landed files."""

from indicata.streaming.incremental import (cases_increment, incidents_increment, run_available,
                                            text_schema)

__all__ = ["cases_increment", "incidents_increment", "run_available", "text_schema"]
