"""Reading and writing: scans, text formats, JDBC options, versioned tables."""
