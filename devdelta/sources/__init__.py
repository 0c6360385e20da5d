"""Sources: Kafka (stream and batch), Kafka-shaped files, fixture messages."""
