"""Weekly topic-signal analytics expressed as Spark DataFrame operators."""
