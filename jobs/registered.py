"""The jobs as queries: each runs its job twice over the whole tables and returns what it has written."""

from __future__ import annotations

from jobs import session_analysis, session_notes

QUERIES = {"job1_session_notes": session_notes.query, "job2_session_analysis": session_analysis.query}
ORACLES = {"job1_session_notes": session_notes.ORACLE, "job2_session_analysis": session_analysis.ORACLE}
