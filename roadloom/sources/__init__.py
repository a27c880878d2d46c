"""Reading and writing the link, node, edge and request tables."""
