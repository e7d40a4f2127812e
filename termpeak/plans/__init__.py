"""The job from end to end, and how it is laid out on a cluster."""
