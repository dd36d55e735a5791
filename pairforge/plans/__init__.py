"""Compositions: the iteration driver and the contract-query catalogue with its SQL oracle."""
