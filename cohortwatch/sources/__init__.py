"""Reading and writing: message topics, files, tables and named results."""
