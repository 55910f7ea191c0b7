"""Reading and writing: files, topics, tables and the sample data."""
