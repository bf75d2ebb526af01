"""Tables, files and databases, in and out."""
