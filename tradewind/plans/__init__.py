"""The two ways through the lake and the warehouse load, put together from operators."""
