"""Financial-statement warehouse jobs for Spark."""
