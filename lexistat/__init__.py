"""Text retrieval and statistical modelling as Spark DataFrame operators."""
