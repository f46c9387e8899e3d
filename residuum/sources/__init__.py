"""Readers: text files in the formats of the field to typed DataFrames."""
