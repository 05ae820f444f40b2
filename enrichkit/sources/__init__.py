"""Readers: CSV, JSON documents, message values, catalogue tables."""

from enrichkit.sources.files import read_csv, read_documents, read_table
from enrichkit.sources.messages import json_values_to_rows
from enrichkit.sources.split_csv import read_split_csv

__all__ = ["json_values_to_rows", "read_csv", "read_documents", "read_split_csv", "read_table"]
