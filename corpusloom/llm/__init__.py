"""Training-data operators on text. Nothing outside this package imports it."""
