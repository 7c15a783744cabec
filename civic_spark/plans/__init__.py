"""Dataset builders (D0–D13), notebook queries (N1–N25) and the driver-table
query registry.  Each builder is a pure function of input DataFrames."""
