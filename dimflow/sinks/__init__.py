"""Writers: dumps, sidecars, manifests, versioned tables, log appends."""
