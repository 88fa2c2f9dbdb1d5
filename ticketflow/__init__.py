"""Ticket-flow and effort analytics on Spark DataFrames."""
