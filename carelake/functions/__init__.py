"""Column-to-column expressions; all run inside whole-stage code generation."""
