"""The vehicle-position feed read as a stream, with the batch operators."""
