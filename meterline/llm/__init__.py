"""Training-data operators: ten first-class components over documents, pages and vectors.

Nothing else in the library imports this subpackage; ``queries`` and
``oracle`` register its operators for the entry module.
"""
