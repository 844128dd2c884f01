"""DataFrame-to-DataFrame operators, to be chained with ``DataFrame.transform``."""
