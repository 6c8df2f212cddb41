"""Operators: functions from DataFrames to a DataFrame.

None of them collects rows. Jobs are run by ``maintenance``, which writes, by ``sizes``, which counts a
dimension before it is broadcast, and by ``quality.enforce``, which has to know whether a check failed.
"""
