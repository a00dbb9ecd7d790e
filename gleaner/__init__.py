"""Spark-native building blocks for collecting and preparing large corpora.

Every operator is ``DataFrame -> DataFrame`` (usable with ``.transform``) or
``Column -> Column``. Nothing in the package fetches from a network; landed
pages, listings, manifests and logs are the inputs.
"""
