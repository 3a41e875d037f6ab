"""Training-data operators over ``documents``, ``pages`` and ``embeddings``.

One module per operator; ``queries`` registers them.  Nothing else in the
library imports this subpackage.
"""
