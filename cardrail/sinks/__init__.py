"""Files and folders the stages write."""
