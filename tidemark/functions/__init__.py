"""Column functions: strings, identifiers, dates, numbers and digests, all on the JVM side."""
