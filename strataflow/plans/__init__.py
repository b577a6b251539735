"""Composed jobs: the layered build over the derived sources and the reports."""
