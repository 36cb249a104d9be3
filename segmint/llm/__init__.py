"""Operators for preparing training text: personal data, site lists, toxicity, packing,
near-duplicate and repeated-passage search, vector search and sub-word coding.

Nothing outside this subpackage imports it. ``segmint.llm.queries`` holds its
registered queries, ``segmint.llm.oracle`` their SQL twins.
"""
