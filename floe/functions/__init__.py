"""Column functions: projection, cell encoding, ring geometry and identities."""
