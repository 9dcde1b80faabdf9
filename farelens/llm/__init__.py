"""Operators for training data: each module holds one operator, its registered query and, where there is one, its SQL."""
