"""DataFrame to DataFrame operators; chain them with ``df.transform``."""
