"""Column functions: text, time, ids and wire encoding. All run in the JVM."""
