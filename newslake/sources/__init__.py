"""Where data comes from: the hour-partitioned lake and message streams."""
