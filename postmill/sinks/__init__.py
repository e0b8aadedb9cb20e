"""Writers of run artifacts."""
