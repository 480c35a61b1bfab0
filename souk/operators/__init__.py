"""Generic DataFrame operators used by the plans."""
