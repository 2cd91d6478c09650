"""Named queries over the data folder, their SQL oracles, and fixtures."""
