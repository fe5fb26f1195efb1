"""Domain operators over DataFrames: mapping/bundles, spine, quality, history, reconcile."""
