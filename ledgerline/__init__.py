"""Filing, ownership, market and exchange-rate analytics as Spark plans."""
