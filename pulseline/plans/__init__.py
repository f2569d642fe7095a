"""Registered queries: derived inputs (``fixtures``), the query catalog and its SQL oracles."""
