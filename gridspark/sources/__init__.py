"""Workbooks as cell tables."""
