"""Readers: Kafka / JDBC / files behind one function per source."""
