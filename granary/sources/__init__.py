"""Readers for delimited releases, catalogues, landed API pages and databases."""
