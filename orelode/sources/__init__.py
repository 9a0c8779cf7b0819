"""Files in and out: delivered text, landed snapshots, layer tables, published results."""
