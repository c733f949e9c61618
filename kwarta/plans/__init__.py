"""The queries: silver loads, marts, reports and checks."""
