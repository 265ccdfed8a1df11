"""leafgraph: page tokens to layout regions, region graphs and question-answer rows, on Spark DataFrames."""

__version__ = "0.1.0"
