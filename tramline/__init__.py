"""Transit operations analytics as PySpark DataFrame functions.

Every operator takes DataFrames plus plain parameters and returns a DataFrame;
only ``tramline.sinks`` and ``tramline.streaming`` run actions.
"""
