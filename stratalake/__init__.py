"""Layered (raw -> validated -> curated) data loading and reporting on PySpark."""
