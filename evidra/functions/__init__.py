"""Column functions: text features, pattern catalogues, patches and symbols."""
