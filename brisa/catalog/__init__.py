"""Every operator and report as a named query over one folder of tables."""

from brisa.catalog import base, kept, loading, operators, reports, scalars, whole

ENTRIES = base.ENTRIES

__all__ = ["ENTRIES", "base", "kept", "loading", "operators", "reports", "scalars", "whole"]
