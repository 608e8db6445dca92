"""Tidemill: cleaning, classifying and enriching short posts with PySpark.

``functions``  Column -> Column building blocks (no UDFs)
``operators``  DataFrame -> DataFrame steps, usable on batch and stream frames
``sources``    scans and message streams
``streaming``  watermarks, late records, batch logs, fan-out
``plans``      the end-to-end flows put together from the above
"""
