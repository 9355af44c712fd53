"""Catalog tables and topics to append to. Both must already exist."""
