"""Compositions: whole reports, the bronze/silver run, the analysis SQL."""
