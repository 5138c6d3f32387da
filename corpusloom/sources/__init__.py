"""Corpusloom: sources."""
