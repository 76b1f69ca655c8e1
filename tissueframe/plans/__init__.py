"""Plan shaping shared by the operators: skew, cells, quantiles, ranks, graphs."""
