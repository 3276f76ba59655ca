"""Writers: files, topics, databases."""
