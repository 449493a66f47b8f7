"""Windows over event streams (an extension; the batch engine has no streams)."""
