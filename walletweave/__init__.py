"""walletweave: a PySpark-native engine for fork-aware wallet intelligence."""
