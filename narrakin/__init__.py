"""Match bank-transaction narrations to a company master on Spark."""
