"""Table definitions, the visit warehouse load, and the reports on top of it."""
