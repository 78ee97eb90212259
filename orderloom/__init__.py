"""Order-line mart on Spark: conforming pipelines, control state and publishing."""
