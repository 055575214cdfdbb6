"""Operations of a training-data pipeline, each a Spark job over whole tables.

Nothing outside this package imports it; the package can be removed as a whole.
"""
