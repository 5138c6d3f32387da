"""Corpusloom: streaming."""
