"""Landing files in, tables out."""
