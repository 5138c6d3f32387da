"""Corpusloom: plans."""
