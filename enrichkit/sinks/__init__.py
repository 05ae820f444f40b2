"""Writers: CSV, text, documents, keyed overwrite, create-table-as."""

from enrichkit.sinks.files import create_table_as, keyed_overwrite, write_csv, write_documents, write_text

__all__ = ["create_table_as", "keyed_overwrite", "write_csv", "write_documents", "write_text"]
