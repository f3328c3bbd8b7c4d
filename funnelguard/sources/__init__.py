"""Fact tables (S1), alert configuration (S2) and the test-fixture views."""
