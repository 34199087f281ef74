"""Named queries over the catalogue and the driver tables."""
