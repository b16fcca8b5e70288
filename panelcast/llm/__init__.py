"""Operators for large training-data pipelines (text in, text or ids out).

One module per operator; :mod:`panelcast.llm.catalog` names their queries.
Nothing outside this subpackage imports it.
"""
