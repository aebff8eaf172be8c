"""The retail lakehouse: raw tables to clean tables, star schema, features, checks, reports."""
