"""Runnable jobs, and the queries that run each over the whole of the given tables.

    python -m jobs.session_notes --config jobs/session_notes.json --input ... --output ... --checkpoint ...
    python -m jobs.session_analysis --config jobs/session_analysis.json --input ... --output ...
"""
