"""Message tables (topics) and catalog tables to read from."""
