"""Readers: landed feed files, tables, landed pages; catalog DDL; sinks."""
