"""DataFrame -> DataFrame operators, usable through ``df.transform``."""
