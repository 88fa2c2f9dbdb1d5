"""Reading input tables and reports, writing result tables."""
