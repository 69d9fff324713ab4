"""What is read and written: rasters as tables, manifests, vector layers, summaries."""
