"""Turn landed bank-notification messages into an analytics-ready ledger with Spark."""
