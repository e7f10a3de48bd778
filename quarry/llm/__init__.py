"""Operations of a training-data pipeline, each a Spark job over a table.

One module per operator; ``common`` holds what several share. The registered
queries are in ``queries`` and their SQL, where SQL can express them, in
``oracles``. Nothing outside this package imports it.
"""
