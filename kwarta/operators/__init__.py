"""Table operators the plans are composed from."""
