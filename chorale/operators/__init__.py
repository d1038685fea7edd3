"""DataFrame-to-DataFrame operators, chainable with ``DataFrame.transform``."""
