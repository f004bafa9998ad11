"""Operators for building text corpora for language models.

Nothing outside this subpackage imports it. Shared conventions:

* An operator reads the id and text columns that it is told of and returns the
  id with its result columns; other columns of the input, whatever their names,
  are neither read nor returned, unless the docstring says so.
* A null text counts as an empty one unless stated otherwise.
* Internal columns start with two underscores.
"""
