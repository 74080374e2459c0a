"""Reading and writing tables, models and the run log."""
