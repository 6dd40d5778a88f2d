"""Retail analytics as PySpark DataFrame operators.

``sources``   readers and writers for the raw feeds and the star schema
``functions`` column expressions (code numbers, strict and lenient parsing, dates, money)
``operators`` reusable DataFrame -> DataFrame operators and data-quality gates
``plans``     the product bridge, the star schema, the batch run and the four metrics
"""
