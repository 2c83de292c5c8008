"""Writers: store appends, the GeoParquet deliverable, the alias atlas JSON."""
