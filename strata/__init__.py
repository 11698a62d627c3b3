"""Layered quote analytics on PySpark: landed JSON -> Bronze -> Silver -> marts."""
