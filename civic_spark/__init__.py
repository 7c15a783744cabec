"""civic_spark — Spark-native wrangling and analysis of electoral open data.

Sub-packages:
    sources    scans and sinks for the raw yearly feeds (S1–S21)
    functions  column expressions with R null semantics (X*, P*, F11–F14)
    operators  joins, aggregates, group filters, windows, sorting, unions (J*, A*, W*, O*, U*, M*)
    plans      derived datasets D0–D13, notebook queries N1–N25, driver-table queries
    streaming  incremental landing of yearly feed files
"""

__version__ = "0.1.0"
