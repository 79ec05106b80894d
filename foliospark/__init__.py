"""Spark-native preparation, search and evaluation of document corpora and chat logs."""

__version__ = "0.1.0"
