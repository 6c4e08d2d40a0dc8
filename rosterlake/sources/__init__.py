"""Tables, documents and the work folder."""
