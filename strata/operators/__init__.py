"""DataFrame -> DataFrame operators that take more than one Spark call."""
