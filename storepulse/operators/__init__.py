"""DataFrame operators shared by the batch plans and the streams."""
