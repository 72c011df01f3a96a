"""Operators of a training-data pipeline, one module per operator.

Nothing else in the library imports this package.  Shared rules:

* a document is identified by ``(doc_id, xxhash64(text))``; rows that repeat
  both are one document and get one result, their multiplicity is kept;
* a null text counts as the empty text unless a docstring says otherwise;
* columns beyond those named in a signature are ignored, whatever their name.
"""
