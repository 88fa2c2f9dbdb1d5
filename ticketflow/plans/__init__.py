"""Whole plans: the booked-time table, the reports, the registered queries."""
