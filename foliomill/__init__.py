"""foliomill: a PySpark engine for long structured documents."""
