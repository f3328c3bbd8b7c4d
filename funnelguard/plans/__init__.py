"""Whole-run plan (G1), sinks (K2, K3), the registered query catalog and its SQL oracle."""
