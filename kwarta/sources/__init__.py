"""Where events and tables are read from."""
