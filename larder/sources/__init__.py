"""Files in and files out."""
