"""Writers: stage, backup, publish through the catalog, side copies, audit."""
