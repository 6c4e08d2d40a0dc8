"""Timesheet and staffing analytics as Spark jobs."""
