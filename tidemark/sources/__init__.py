"""Reading landed files, flattening documents and keeping tables up to date."""
