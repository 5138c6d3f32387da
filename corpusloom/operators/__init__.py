"""Corpusloom: operators."""
