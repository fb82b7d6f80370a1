"""Schemas of the tables that the engine exchanges, and constants that are part of their meaning."""

#: Part of every content hash and point identifier.
INDEX_VERSION = "table-aware-v2"
POINT_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"
PAGE = 100
READ_BLOCK = 1 << 20

#: The file suffixes that are indexed.
TEXT_SUFFIXES = (".txt", ".md", ".markdown", ".rst", ".log")
RICH_SUFFIXES = (".pdf", ".docx", ".pptx", ".xlsx", ".xls", ".html", ".htm", ".csv")
SUPPORTED = TEXT_SUFFIXES + RICH_SUFFIXES

CHUNK = "text string, headings array<string>, atomic boolean, chunk_type string, table_ref string, embedding_parts array<string>, row_count int"
FILES = "rel_path string, size bigint, mtime double, path string"
DISK = "rel_path string, file_hash string"
INDEXED = "source_path string, file_hash string"
POINTS = "id string, vector array<double>, source_path string, chunk_index int, text string, file_hash string, index_version string, chunk_type string, headings array<string>, table_ref string, row_count int"
CHANGES = "seq bigint, op string, path string, is_prefix boolean"
FS_EVENTS = "seq bigint, ts timestamp, event_type string, src_path string, dest_path string, is_directory boolean"
SNAPSHOT = "rel_path string, size bigint, mtime double"
