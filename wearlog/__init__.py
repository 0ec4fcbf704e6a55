"""Run-to-failure sensor logs on Spark: layers, labels, scaling, life model, live scoring."""
