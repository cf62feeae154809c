"""Reading and writing: dataset versions, logs, documents."""
