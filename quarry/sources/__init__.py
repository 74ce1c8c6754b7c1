"""Tab-separated sources and sinks."""

from quarry.sources.files import concatenate, write_sorted_file, write_wide_rows
from quarry.sources.tsv import (Kind, read_by_value, read_kinds, read_matrix, read_parts, read_tagged, read_tsv,
                                read_vectors, read_weights, to_tsv_line, write_by_value, write_lines, write_parts, write_tsv)

__all__ = ["read_tsv", "read_tagged", "read_kinds", "Kind", "read_matrix", "read_vectors", "read_weights", "read_by_value",
           "read_parts", "write_tsv", "write_lines", "write_by_value", "write_parts", "write_sorted_file",
           "write_wide_rows", "concatenate", "to_tsv_line"]
