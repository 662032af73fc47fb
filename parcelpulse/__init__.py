"""parcelpulse: order-flow analytics as Spark DataFrame jobs."""
