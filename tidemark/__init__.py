"""Tidemark: retail order analytics and customer retention planning as Spark DataFrame operators."""
