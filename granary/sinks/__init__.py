"""Writers and catalog tables."""
