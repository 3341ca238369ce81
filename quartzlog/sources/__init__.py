"""Where logs and files are kept."""
