from .audit import audit_files, collect_file_metadata, file_hashes, validate_file_exists, validate_file_input
from .layouts import layout_findings, text_layouts
from .readers import read_table, read_table_from_spec, read_two_row_header
from .writers import write_table

__all__ = [
    "audit_files",
    "collect_file_metadata",
    "file_hashes",
    "layout_findings",
    "read_table",
    "read_table_from_spec",
    "read_two_row_header",
    "text_layouts",
    "validate_file_exists",
    "validate_file_input",
    "write_table",
]
