"""Row and column transforms shared by the batch and streaming jobs."""
