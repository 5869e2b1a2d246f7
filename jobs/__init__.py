"""Runnable jobs, and the queries that run each of them twice over whole tables."""

from __future__ import annotations

from jobs import expression, landing

QUERIES = {"job1_expression": expression.job1_expression, "job2_landing": landing.job2_landing}
ORACLES = {"job1_expression": expression.JOB1_SQL, "job2_landing": landing.JOB2_SQL}
