"""Training-data operators: packing, quality, language models, mixing, encoding, URLs, copies, archives.

Nothing else in the library imports this folder.
"""
