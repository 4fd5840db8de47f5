"""Sources: file listings, bytes, decoded images and earlier results."""
