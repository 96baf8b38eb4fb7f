"""Point observations and grid cubes as Spark DataFrames.

A *cube* has one row per cell and time: key columns (``time``, ``lat``, ``lon``
and sometimes ``forecast``) and one numeric column per variable. A missing cell
is an absent row or a NULL. A *point table* has one row per detection.
"""
