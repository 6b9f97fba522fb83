"""Named queries: functions from the five tables to a DataFrame."""
