"""Message streams, tables and logs as DataFrames."""
