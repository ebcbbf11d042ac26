"""Operators of a training-data pipeline, one module per operator.

Nothing outside this folder imports it except the guard in
``__spark_entry__.py``; deleting it leaves the rest of the library whole.
``grist.llm.registry`` names the queries and their SQL.
"""
