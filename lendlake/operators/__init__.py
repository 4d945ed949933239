"""DataFrame operators: rules, stress, bureau, data set, model life-cycle, drift, quality."""
