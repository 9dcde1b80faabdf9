"""Column functions shared by the batch and the stream path."""
