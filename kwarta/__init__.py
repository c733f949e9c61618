"""A Spark engine for e-wallet transactions: silver loads, fraud rules, marts, reports, checks."""
