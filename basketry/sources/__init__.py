"""Readers: landed files, tables and the retail views over the star schema."""
