"""refrain: prepares, loads and analyses item/entity catalogues on Spark.

Items (such as tracks) carry a list of the entities (such as artists) they
belong to. Every step is a DataFrame transform over built-in expressions.
"""

__version__ = "0.1.0"
