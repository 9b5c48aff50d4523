"""DataFrame-in, DataFrame-out operators of the extract / load flow."""
