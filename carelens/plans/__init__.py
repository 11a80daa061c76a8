"""Composed pipelines: bronze (B1-B3), gold (B4), dashboard (B5), file runner."""
