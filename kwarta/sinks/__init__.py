"""Where results are written."""
