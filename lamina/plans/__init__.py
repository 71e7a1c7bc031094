"""The certificate medallion, put together from the operators."""
