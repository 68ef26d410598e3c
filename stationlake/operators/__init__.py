"""Operators on whole tables: filters, station search, requests at places, records."""
