"""The analyses: tidy deliveries, ledger, cubes, costs and flow graph."""
