"""DataFrame steps: documents to tokens, term frequencies and peaks."""
