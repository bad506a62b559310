"""Whole jobs: collected tables in, published tables and their audit out."""
