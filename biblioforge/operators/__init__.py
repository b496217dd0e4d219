"""DataFrame -> DataFrame operators: generic relational idioms and the bibliographic entities built from them."""
