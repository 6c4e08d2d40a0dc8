"""Column expressions shared by the layers; all run inside the JVM."""
