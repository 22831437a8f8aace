"""Training-data operators over documents, pages and conversations.

Each module holds one operator with its own interface and the thin registered
query derived from it. Nothing else in the library imports this package.
"""
