"""All DuckDB checks by query name."""

from __future__ import annotations

from oracles import jobs, reports, views

SQL: dict[str, str] = {**reports.SQL, **jobs.SQL, **views.SQL}
