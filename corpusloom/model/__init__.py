"""Corpusloom: model."""
