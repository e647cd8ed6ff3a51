"""Training-data operators: thirteen building blocks and the corpus pipeline's stages.

Nothing else in the library imports this subpackage.
"""
