"""Column expressions without state: coordinates, motifs, fractions, status strings."""
