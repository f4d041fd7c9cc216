from .helpers import docs_of, edge_docs, small_docs  # noqa: F401
