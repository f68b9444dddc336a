"""Column expressions shared by batch, streaming and SQL."""
