"""Column functions; all but the JPEG probe stay in the JVM."""
