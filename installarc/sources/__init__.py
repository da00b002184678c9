"""Reading, writing and the sample input views."""
