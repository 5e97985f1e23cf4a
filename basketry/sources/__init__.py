"""Sources: driver tables, the adapters to the input contracts, Kafka and files."""
