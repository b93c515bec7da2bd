"""End-to-end jobs composed from operators; each takes and returns DataFrames."""
