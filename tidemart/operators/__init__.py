"""Relational and keyed operators over DataFrames; no input or output happens here."""
