"""quotewell: a Spark-native warehouse of daily security prices, with cross-source reconciliation."""
