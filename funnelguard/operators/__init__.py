"""Scoping (O1-O8), the seven checks and the alert record builder (K1)."""
