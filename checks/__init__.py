"""Every operator run on the given tables, each with an independent SQL answer."""
