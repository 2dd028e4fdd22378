"""Point-cloud analytics as plain functions from DataFrame to DataFrame."""
