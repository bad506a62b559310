"""Reading collected tables and writing published ones."""
